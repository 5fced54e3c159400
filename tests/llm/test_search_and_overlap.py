import itertools
import math
import random

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, topk
from ledgerlake.llm import queries as Q
from ledgerlake.llm.neardup import word_hashes
from oracle_check import compare, duck

VECS = "vec_id bigint, embedding array<float>, rank int"


def brute(rows, is_query, k):
    own = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in own:
        if is_query(q):
            scores = [(sum(x * y for x, y in zip(a, b)), i) for i, b in own if i != q and len(a) == len(b)]
            found = sorted((-max(-2**63 + 1, min(2**63 - 1, s)), i) for s, i in scores)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def test_top_k_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.125, 0.7]) for _ in range(4)]) for i in range(230)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (400, [float("inf")] * 4), (None, [1.0] * 4),
             (500, [1.0, 2.0]), (501, [1.0, 3.0]), (600, []), (7, [0.25] * 4), (7, [0.25] * 4), (-100, [0.7] * 4)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECS)
    out = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0).collect()))
    assert out == brute(rows, lambda i: i % 100 == 0, 10)


def test_top_k_large_components(spark):
    rows = [(i, [float((i * 37 % 11 - 5) * 2 ** 40), float(i)]) for i in range(101)]
    out = sorted(map(tuple, topk.top_k(spark.createDataFrame([(i, v, 0) for i, v in rows], VECS), F.col("vec_id") % 100 == 0).collect()))
    assert out == brute(rows, lambda i: i % 100 == 0, 10)


def test_top_k_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "TILE", 8)
    monkeypatch.setattr(topk, "FAN", 2)
    rng = random.Random(5)
    rows = [(i, [rng.random() for _ in range(3)]) for i in range(400)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECS).repartition(4)
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 10 == 0, k=3).collect())) == brute(rows, lambda i: i % 10 == 0, 3)


def test_top_k_empty_and_sql(spark, sf):
    assert topk.top_k(spark.createDataFrame([], VECS), F.col("vec_id") % 100 == 0).count() == 0
    ok, msg = compare(spark, "op6", Q.op6_top_k, Q.ORACLE["op6_top_k"], sf, duck(sf))
    assert ok, msg


def overlap_brute(docs, items):
    """Every shift of every item over every text."""
    out = set()
    words = lambda t: [int(x) >> 48 for x in word_hashes(pa.array([t], pa.string()))[0]]
    for d, t in docs:
        a = words(t)
        for i, s in items:
            b = words(s)
            size = min(decontaminate.WINDOW, len(b))
            if len(b) < decontaminate.SHORTEST:
                continue
            for shift in range(-len(b), len(a) + 1):
                same = [0 <= shift + k < len(a) and a[shift + k] == b[k] for k in range(len(b))]
                inside = [0 <= shift + k < len(a) for k in range(len(b))]
                if any(all(inside[k:k + size]) and sum(same[k:k + size]) >= 0.8 * size for k in range(len(b) - size + 1)):
                    out.add((d, i))
    return out


def test_overlaps_match_brute_force(spark, make_docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 7, 12, 16, 30, 60])))) for i in range(40)] + [(90, None), (91, "")]
    docs = []
    for d in range(60):
        own = [word() for _ in range(rng.randrange(0, 60))]
        if d % 2:
            _, text = rng.choice(items[:40])
            part = text.split()
            for _ in range(rng.randrange(0, max(1, len(part) // 8 + 1))):
                part[rng.randrange(len(part))] = word()
            at = rng.randrange(len(own) + 1)
            own[at:at] = [w.upper() if rng.random() < 0.2 else w for w in part]
        docs.append((d, " ".join(own)))
    docs += [(100, None), (101, ""), (None, items[4][1]), (102, items[5][1]), (102, items[5][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("seed", F.lit(1))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(make_docs(docs, ["seed", "at"]), bench).collect()}
    want = overlap_brute(docs, items)
    assert found <= want and len(found) >= 0.95 * len(want) and (102, 5) in found
    kept = [r["doc_id"] for r in decontaminate.clean(make_docs(docs), bench).collect()]
    assert sorted(x for x in kept if x is not None) == sorted(d for d, _ in docs if d is not None and d not in {f for f, _ in found})
    rows = decontaminate.report(make_docs(docs), bench).collect()
    assert len(rows) == len(docs) and {r["doc_id"] for r in rows if r["contaminated"]} == {f for f, _ in found}


def test_every_overlap_is_found(spark, make_docs):
    # items of 1 to 17 words with all placements of the words that may differ, and one more
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in range(1, 18)]
    docs, want = [], set()
    for n, text in items:
        size = min(n, decontaminate.WINDOW)
        may = size - math.ceil(0.8 * size)
        for more in (0, 1):
            for at in list(itertools.combinations(range(size), may + more))[:600 if not more else 20]:
                words = [f"v{len(docs)}x{k}" if k in at else w for k, w in enumerate(text.split()[:size])]
                docs.append((len(docs), " ".join(["before it", *words, "and after"])))
                if not more:
                    want.add((docs[-1][0], n))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(make_docs(docs), bench).collect()}
    assert found == want


def test_overlaps_equal_brute_force(spark, make_docs):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 40)))) for i in range(30)]
    docs = []
    for d in range(60):
        part = rng.choice(items)[1].split()
        for _ in range(rng.randrange(0, len(part) // 4 + 1)):
            part[rng.randrange(len(part))] = rng.choice("abcdefgh")
        docs.append((d, " ".join([rng.choice("abcdefgh") for _ in range(rng.randrange(9))] + part)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(make_docs(docs), bench).collect()}
    assert found == overlap_brute(docs, items)


def test_overlaps_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.report(make_docs([]), none).count() == 0
    assert [r["contaminated"] for r in decontaminate.report(make_docs([(1, "some words of a text")]), none).collect()] == [False]
