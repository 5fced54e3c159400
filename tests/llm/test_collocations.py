import random
import re
from collections import Counter, defaultdict

import pytest
from oracle_check import compare, duck

from ledgerlake.llm import collocations
from ledgerlake.llm import queries as Q


def brute(rows, least, most=5, first=2000):
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(upper)):
            words = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(words)
            for k in range(1, most + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in frequent.items():
            inside = any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in frequent.items())
            if not inside:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                kept.append((" ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], score))
        kept.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out |= {(lang, i + 1, *r) for i, r in enumerate(kept[:first])}
    return out


def found(docs, **kw):
    return {tuple(r) for r in collocations.ranked(docs, **kw).collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    words = ["the", "The", "of", "a\x01b", "a", "new", "york", "city", "hall", "é", "ÉTÉ", "x|y", "\x00", "to", "be", "naïve", "zz\xa0z"]
    fixed = ["new york city hall", "to be the", "a a a a a a a"]
    out = [(i, "".join(rng.choice([*words, *fixed]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "; ", "\r\n"])
                       for _ in range(rng.randrange(0, 60))), rng.choice(["en", "fr", None])) for i in range(150)]
    return out + [(900, None, "en"), (901, "", "en"), (902, "...", "de"), (903, "lone", "sv"), out[3], out[3], (None, "to be the new", None),
                  (904, "to be the " * 4000, "long"), (905, "q" * 50000, "long")]


@pytest.mark.parametrize("least", [2, 7, 30])
def test_against_brute_force(make_docs, rows, least):
    assert found(make_docs(rows, ["f", "phrase", "words", "n"]), least=least) == brute(rows, least)


def test_first_rows_and_shorter_phrases(make_docs, rows):
    assert found(make_docs(rows), least=3, most=3, first=4) == brute(rows, 3, 3, 4)


def test_query_matches_sql(spark, sf):
    ok, msg = compare(spark, "op12", Q.op12_collocations, Q.ORACLE["op12_collocations"], sf, duck(sf))
    assert ok, msg


@pytest.mark.parametrize("given", [[], [(1, None, "en")], [(1, "", None), (2, " .,", "en")], [(1, "too rare", "en")]])
def test_tables_without_phrases(make_docs, given):
    assert collocations.ranked(make_docs(given)).count() == 0


def test_scan_over_shards_equals_one_pass():
    """Cutting the stream anywhere changes nothing, once rows of one phrase are put together."""
    rng = random.Random(3)
    texts = [tuple(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    counts = Counter(t[:k] for t in texts for k in range(1, len(t) + 1))
    stream = sorted(("l", list(p), n) for p, n in counts.items())
    def together(rows):
        out = {}
        for r in rows:
            old = out.setdefault(tuple(r["words"]), [r["f"], None, 0])
            out[tuple(r["words"])] = [r["f"], r["parts"] if r["parts"] is not None else old[1], max(old[2], r["most"])]
        return out
    whole = together(collocations.scan(((0, *r) for r in stream), {}))
    for size in (1, 2, 5):
        shard = [i // size for i in range(len(stream))]
        carried = {s: [(la, w, n) for la, w, n in stream[:s * size] if stream[s * size][1][:len(w)] == w] for s in set(shard)}
        assert together(collocations.scan(((s, *r) for s, r in zip(shard, stream)), carried)) == whole


def test_scores_beyond_64_bits():
    assert collocations.best_cut(["a", "b", "c"], 10**12, 10**16, [10**13, 10**12], [10**12, 10**14]) == (10**4, 10**13, 10**14)
    a, n = 3 * 10**14 + 7, 9 * 10**17 + 1
    score, left, right = collocations.best_cut(["a", "b"], a, n, [a + 5], [a + 9])
    assert (left, right) == (a + 5, a + 9) and score == 1000 * a * n // ((a + 5) * (a + 9))
    # equal after flooring: the first cut counts
    assert collocations.best_cut(["a", "b", "c"], 10, 100, [1000, 999], [998, 1000])[1:] == (1000, 1000)
