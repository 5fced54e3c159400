import random

import numpy as np
import pyarrow as pa

from ledgerlake.llm import neardup
from ledgerlake.llm.groups import parities


def texts(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(60, 200))]
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(0, 5)):
                i = rng.randrange(len(own))
                own[i:i + 1] = rng.choice([[word()], [], [own[i], word()]])
            rows.append(" ".join(own))
        shuffled = base[len(base) // 2:] + base[:len(base) // 2]
        rows.append(" ".join(shuffled))
    passage = " ".join(word() for _ in range(80))
    rows += [passage + " " + " ".join(word() for _ in range(60)) for _ in range(15)]
    return rows


def brute(rows):
    """Class ids from all pairs."""
    labelled = [neardup.kmers((w >> np.uint64(48)).astype("<u2")) for w in neardup.word_hashes(pa.array([t for _, t in rows]))]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(labelled[i]) and len(labelled[j]) and neardup.compare(labelled[i], labelled[j])[1]:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return {d: (min(g, key=lambda x: (x is not None, x or 0)), len(g)) for g in groups.values() for d in g}


def test_classes_match_all_pairs(make_docs):
    rows = list(enumerate(texts()))
    rows += [(500, "Only three words"), (501, "only THREE words!"), (502, None), (503, None), (504, ""), (505, "..."), (506, "word " * 20_000)]
    out = neardup.classes(make_docs(rows, ["node", "root", "x"])).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_class"]) for r in out} == brute(rows)
    assert sorted(r["doc_id"] for r in out) == sorted(d for d, _ in rows)


def test_chain_through_a_member_of_the_centres_class(make_docs):
    # a ~ b ~ c ~ d, but the ends are unlike: links must not depend on the centre
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(8):
        own = list(base)
        for i in range(k * 2):
            own[10 + i * 12] = f"v{i}"
        rows.append((k, " ".join(own)))
    out = neardup.classes(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_class"]) for r in out} == brute(rows)
    assert {r["class_id"] for r in out} == {0}


def test_short_texts_match_all_pairs(make_docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for n in [*range(6, 16)] * 12 + [30, 44, 50]:
        own = [word() for _ in range(n)]
        rows += [own, [*own, word()], [word(), *own], own[:-1], own[1:], [*own[:-1], word()], [word(), word(), *own]][:rng.choice([2, 3, 7])]
    rows = list(enumerate(" ".join(r) for r in rows))
    out = neardup.classes(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_class"]) for r in out} == brute(rows)


def test_links_between_the_fronts_of_two_centres(spark):
    # one bucket; of each chain c1 ~ x ~ z ~ c2 the ends are centres of the same turn, and all hangs on x ~ z
    rng, members, chains = np.random.default_rng(7), {}, []
    for k in range(14):
        words = rng.integers(0, 1 << 16, 140).astype("<u2")
        turn = "a" if k < 4 else "b"
        names = [f"{turn}{k:02}1", f"x{k:02}1", f"x{k:02}2", f"{turn}{k:02}2"]
        members |= {n: words[at:at + 104] for n, at in zip(names, (0, 9, 20, 29))}
        chains.append(names)
    members |= {f"u{k:02}": rng.integers(0, 1 << 16, 104).astype("<u2") for k in range(75)}
    rows = [(bytearray(n.encode()), bytearray(w.tobytes()), [1]) for n, w in members.items()]
    found = neardup.links(spark.createDataFrame(rows, "node binary, codes binary, keys array<bigint>"))
    roots = {bytes(r["node"]).decode(): bytes(r["root"]).decode() for r in neardup.components(found).collect()}
    assert all({roots[n] for n in names} == {min(names)} for names in chains)
    assert len(roots) == 4 * len(chains)


def test_dedup_keeps_one_of_each(make_docs):
    rows = [(1, "the same few words here now"), (2, "the same few words here now"), (2, "the same few words here now"),
            (3, "quite another text than that one"), (None, None), (4, ""), (5, "")]
    out = neardup.dedup(make_docs(rows, ["root", "node"])).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in out) == [(False, 0), (True, 1), (True, 3), (True, 4), (True, 5)]
    twice = neardup.dedup(make_docs([(7, "one repeated row of words"), (7, "one repeated row of words")])).collect()
    assert len(twice) == 1


def test_order_counts():
    a = neardup.kmers(np.arange(100, dtype="<u2"))
    b = neardup.kmers(np.r_[np.arange(50, 100), np.arange(50)].astype("<u2"))
    j, linked = neardup.compare(a, b)
    assert j > 0.8 and not linked


def test_texts_with_a_common_head_are_not_paired(make_docs, monkeypatch):
    """800 texts that share 150 words and no link: few of the 319,600 pairs are compared."""
    rng = random.Random(9)
    head = " ".join(f"h{i}" for i in range(150))
    near = [f"n{i}" for i in range(200)]
    rows = [(i, head + " " + " ".join(f"t{rng.randrange(10**9)}" for _ in range(100))) for i in range(800)]
    rows += [(1000 + i, " ".join(near[:i] + [f"x{i}"] + near[i + 1:])) for i in range(150)]
    compared = []
    real = neardup.able

    def counting(pairs, texts, percent):
        kept = real(pairs, texts, percent)
        compared.append((pairs.count(), kept.count()))
        return kept

    monkeypatch.setattr(neardup, "able", counting)
    out = {r["doc_id"]: (r["class_id"], r["n_class"]) for r in neardup.classes(make_docs(rows)).collect()}
    assert all(out[i] == (i, 1) for i in range(800)) and all(out[1000 + i] == (1000, 150) for i in range(150))
    assert sum(k for _, k in compared) < 5000 and sum(m for m, _ in compared) < 40_000, compared


def test_near_misses_of_a_large_group_are_not_paired(make_docs, monkeypatch):
    """90 texts that are 0.6 to 0.75 like each of 200 near copies, and no copies: hardly one of the 18,000 pairs is made."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(160)]

    def changed(times):
        own = list(base)
        for at in rng.sample(range(16), times):
            own[10 * at + rng.randrange(3)] = f"c{rng.randrange(10**9)}"
        return " ".join(own)

    rows = list(enumerate([changed(1) for _ in range(200)] + [changed(6) for _ in range(90)]))
    made = []
    real = neardup.able

    def counting(pairs, texts, percent):
        made.append(pairs.count())
        return real(pairs, texts, percent)

    monkeypatch.setattr(neardup, "able", counting)
    out = neardup.classes(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_class"]) for r in out} == brute(rows)
    assert len({r["class_id"] for r in out}) == 91
    assert sum(made) < 2000, made


def test_parities_never_differ_more_than_the_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)) for n in (0, 1, 40, 300, 5000)]
    sets += [np.r_[s[:len(s) * 9 // 10], s[:len(s) // 9] + np.uint64(1 << 50)] for s in sets] * 60    # more sets than are made at once
    bits = parities(np.concatenate(sets), np.cumsum([0, *map(len, sets)])).to_pylist()
    assert {len(b) for b in bits} == {16} and not any(bits[0])
    for i in range(5):
        for j in range(len(sets)):
            apart = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(bits[i], bits[j]))
            assert apart <= len(np.setxor1d(sets[i], sets[j]))


def test_sketch_of_long_texts(monkeypatch):
    labelled = neardup.kmers(np.random.default_rng(1).integers(0, 1 << 16, 5000).astype("<u2"))
    whole = neardup.sketch(labelled)
    monkeypatch.setattr(neardup, "AT_ONCE", 1)
    assert (neardup.sketch(labelled) == whole).all()


def test_empty_table(make_docs):
    assert neardup.classes(make_docs([])).count() == 0
