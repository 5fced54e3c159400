import random
import re

import numpy as np
import pyarrow as pa
import pytest
from oracle_check import compare, duck

from ledgerlake.llm import groups, jaccard
from ledgerlake.llm import queries as Q


def brute(rows, percent=90):
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    sets = []
    for _, text in rows:
        w = [x for x in re.split("[ \t\n\x0b\x0c\r]", (text or "").translate(upper)) if x]
        sets.append({tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def found(docs, **kw):
    return sorted((tuple(r) for r in jaccard.joined(docs, **kw).collect()), key=str)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[i] = f"e{rng.randrange(10**6)}"
        elif kind == 1:
            del words[i]
        else:
            words.insert(i, f"n{rng.randrange(10**6)}")
    return words


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    word = lambda: f"w{min(rng.randrange(1, 400), rng.randrange(1, 400))}"
    out = []
    for size in (1, 2, 3, 4, 12, 13, 30, 60, 61, 120, 300):  # groups of near copies of every length, and chains of edits
        base = [word() for _ in range(size)]
        for g in range(10):
            base = edited(rng, base, rng.randrange(0, max(2, size // 25))) if rng.random() < 0.5 and len(base) > 3 else base
            out.append(" ".join(edited(rng, base, rng.randrange(0, max(2, size // 30))) if len(base) > 3 else base))
    head = " ".join(word() for _ in range(80))
    out += [head + " " + " ".join(word() for _ in range(rng.randrange(0, 60))) for _ in range(40)]
    out += ["The the THE the", "the the the the", "one", "ONE ", "\tone\n", "", None, " \n", "É é", "é É", "a b", "A\x0bB", "x " * 9000]
    docs = [(i * 3, t) for i, t in enumerate(out)]
    rng.shuffle(docs)
    return docs + [(None, out[5]), (None, "alone without any id"), docs[0], docs[0], (docs[1][0], "another text with the same id")]


@pytest.mark.parametrize("percent", [90, 70])
def test_against_all_pairs(make_docs, rows, percent):
    assert found(make_docs(rows, ["n", "row", "node", "x"]), percent=percent) == brute(rows, percent)


@pytest.mark.parametrize("most", [1, 8])
def test_any_number_of_matches(make_docs, rows, most, monkeypatch):
    """Few counters make runs look frequent, so that prefixes grow; the links stay."""
    monkeypatch.setattr(jaccard, "COUNTERS", 64)
    assert found(make_docs(rows), most=most) == brute(rows)


def test_prefixes_grow_with_the_cost():
    costs = np.r_[np.zeros(200), np.full(200, 1000)]
    asks = jaccard.matches(costs, np.array([0, 200]), np.array([200, 200]), 90, 8)
    assert asks.tolist() == [1, 8]
    assert jaccard.matches(np.array([9.0, 1.0]), np.array([0]), np.array([2]), 90, 8).tolist() == [2]


@pytest.mark.parametrize("percent", [50, 70, 90, 100])
def test_prefix_filter_loses_nothing(percent):
    """Sets that link share, for every l, l runs of the prefixes that the pair needs."""
    rng = random.Random(percent)
    for _ in range(400):
        a = set(rng.sample(range(60), rng.randrange(1, 40)))
        b = set(rng.sample(sorted(a), rng.randrange(0, len(a) + 1))) | set(rng.sample(range(60), rng.randrange(0, 6))) or {1}
        if 100 * len(a & b) >= percent * len(a | b):
            o = jaccard.shared(len(a), len(b), percent)
            assert len(a & b) >= o and len(a) - o <= jaccard.reach(len(a), percent)
            for k in range(1, o + 1):
                both = set(sorted(a)[:len(a) - o + k]) & set(sorted(b)[:len(b) - o + k])
                assert len(both) >= k


def test_class_counts_never_lose_a_link():
    rng = np.random.default_rng(2)
    for n in (1, 3, 40, 3000, 70_000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.r_[a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, n // 20 + 1, dtype=np.uint64)])
        x, y = (jaccard.counts_of(c) for c in jaccard.class_counts(np.r_[a, b], np.array([0, len(a), len(a) + len(b)])))
        assert x.sum() == len(a) and np.minimum(x, y).sum() >= jaccard.common(a, b)
    one = jaccard.class_counts(np.zeros(70_000, np.uint64), np.array([0, 70_000]))[0]
    assert jaccard.counts_of(one)[0] == 70_000


def test_no_pairs_within_a_group(make_docs, spark):
    """Copies with one word changed each, and texts with a long head in common and no link."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(300)]
    near = [base[:i] + [f"x{i}"] + base[i + 1:] for i in range(200)]
    head = [f"h{i}" for i in range(150)]
    apart = [head + [f"t{rng.randrange(10**9)}" for _ in range(150)] for _ in range(200)]
    docs = make_docs([(i, " ".join(t)) for i, t in enumerate(near + apart)])
    compared = []
    real = jaccard.linked

    def counting(pairs, sets, percent):
        compared.append(pairs.count())
        return real(pairs, sets, percent)

    jaccard.linked = counting
    try:
        out = {r["doc_id"]: r["component_id"] for r in jaccard.joined(docs).collect()}
    finally:
        jaccard.linked = real
    assert all(out[i] == 0 for i in range(200)) and all(out[i] == i for i in range(200, 400))
    assert sum(compared) < 2000, compared


def test_runs_of_short_texts():
    h, bounds = jaccard.shingles(pa.array(["a b c d", "a b", "b a", "a", None, "", "A B\tC  D", "a b c a b c a b c"]))
    own = [h[lo:hi].tolist() for lo, hi in zip(bounds, bounds[1:])]
    assert [len(x) for x in own] == [2, 1, 1, 1, 0, 0, 2, 3] and own[0] == own[6] and own[1] != own[2] != own[3]


def test_query_matches_sql(spark, sf):
    ok, msg = compare(spark, "op11", Q.op11_jaccard_join, Q.ORACLE["op11_jaccard_join"], sf, duck(sf))
    assert ok, msg


@pytest.mark.parametrize("given", [[], [(1, None)], [(2, ""), (None, None)]])
def test_tables_without_runs(make_docs, given):
    assert found(make_docs(given)) == brute(given)


def test_members_without_a_partner_of_their_size_are_left_out(spark, monkeypatch):
    """No pair that counts goes; what has no such partner is not shuffled."""
    rng = random.Random(4)
    nodes = [(i, n, 1, sorted(rng.sample(range(1, 60), groups.reach(n, 90) + 1)))
             for i, n in enumerate(rng.randrange(1, 300) for _ in range(150))]
    df = spark.createDataFrame(nodes, "node bigint, n bigint, weight bigint, prefix array<bigint>")

    def pairs(rows):
        return {(x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and x[3] == y[3] and 90 * x[1] <= 100 * y[1] and 90 * y[1] <= 100 * x[1]
                and x[2] < x[1] + 1 - groups.shared(x[1], y[1], 90) and y[2] < y[1] + 1 - groups.shared(x[1], y[1], 90)}

    every = [(i, n, pos, run) for i, n, _, prefix in nodes for pos, run in enumerate(prefix)]
    own = groups.members_of(df, 90).select("node", "n", "pos", "run").collect()
    assert pairs(own) == pairs(every) and set(map(tuple, own)) <= set(every)
    assert len(own) < len(every)
    for r in own:
        assert any(r["run"] == run and r["node"] != node and 90 * max(r["n"], n) <= 100 * min(r["n"], n) for node, n, _, run in every)
    monkeypatch.setattr(groups, "ORDERED", 3)   # runs of more nodes are left as they are
    many = groups.members_of(df, 90).select("node", "n", "pos", "run").collect()
    assert pairs(many) == pairs(every) and len(many) > len(own)


def test_only_the_nodes_of_pairs_are_sent_to_them(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(jaccard, "broadcast_up_to", lambda df, rows: sent.append(sorted(r[0] for r in df.collect())) or df)
    h = [np.arange(i // 2, i // 2 + 40, dtype=np.uint64) for i in range(9)]
    rows = [(i, len(x), 1, x.astype(np.int64).tolist(), groups.class_counts(x, np.array([0, len(x)]))[0]) for i, x in enumerate(h)]
    nodes = spark.createDataFrame(rows, "node bigint, n bigint, matches int, prefix array<bigint>, classes binary")
    pairs = spark.createDataFrame([(0, 1), (2, 3), (0, 3)], "a bigint, b bigint")
    assert sorted(map(tuple, jaccard.promising(pairs, nodes, 90).collect())) == [(0, 1), (0, 3), (2, 3)]
    assert sent == [[0, 1, 2, 3]]
