"""Benchmark decontamination by spaced seeds.

Each mask of ``MASKS`` hashes the words it marks with 1 and ignores the others,
so a seed still hits when an ignored word was replaced.  The masks depend on the
item's length, and no overlap escapes all of them; training texts are searched
with those that some item needs.  Hashes of all
positions of benchmark and training texts are joined; around a hit the two
texts are laid on top of each other, and a document overlaps an item when some
``WINDOW`` consecutive words of the item (all of them, if it has fewer) agree
in at least ``IDENTITY`` of the places.

A bitmap of fixed size over the benchmark's hashes, whatever their number,
keeps training positions without a partner out of the join.  What goes into it
carries the words around the position, so no text is shuffled.

Words are lower-case runs of letters and digits.  Null texts have none.  Items
without a word are not searched for.  Rows equal in id and
text share a result.  Empty tables give no overlaps.  Other columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.bitmaps import BITS, bitmap, known
from ledgerlake.llm.common import batches, small_batches, stored
from ledgerlake.llm.neardup import ODD, flat_hashes, mix, word_hashes

# The words that a seed looks at, for items from so many words on.  Wherever the
# words that may differ (3 of 15 and 16, 2 of 10, 1 of 5) stand, one mask fits between.
MASKS = {15: ("1110111", "111000010011", "110100100001001"), 10: ("11111", "111011", "11010011"), 6: ("1111", "110011"),
         5: ("1111", "11011", "10111", "11101"), 4: ("1111",), 3: ("111",), 2: ("11",), 1: ("1",)}
SHORTEST = 1
WINDOW = 16
IDENTITY = 0.8
HITS_DDL = "seed bigint, doc_id bigint, x bigint, at int, around binary"


def masks_of(n: int) -> tuple[str, ...]:
    """The masks for an item of n words."""
    return next((masks for least, masks in MASKS.items() if n >= least), ())


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, mixed = np.full(n, int(mask, 2), np.uint64), mix(words)
    for j, bit in enumerate(mask):
        if bit == "1":
            h = h * ODD + mixed[j:j + n]
    return mix(h)


def codes(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(48)).astype("<u2")


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """seed, item_id, pos and the item's words, for every position and mask."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for b in it:
                for item, words in zip(b.column(0).to_pylist(), word_hashes(b.column(1))):
                    own = codes(words).tobytes()
                    for mask in masks_of(len(words)):
                        for pos, seed in enumerate(seeds(words, mask).view(np.int64).tolist()):
                            yield {"seed": seed, "item_id": item, "pos": pos, "words": own}

        yield from batches(rows(), pa.schema([("seed", pa.int64()), ("item_id", pa.int64()), ("pos", pa.int32()), ("words", pa.binary())]))

    return benchmark.select(F.col("item_id").cast("bigint"), "text").mapInArrow(
        run, "seed bigint, item_id bigint, pos int, words binary")


def overlaps(item: np.ndarray, pos: int, around: np.ndarray, at: int) -> bool:
    """``around[at]`` is the document's word on the item's word ``pos``."""
    shift = at - pos
    lo, hi = max(0, -shift), min(len(item), len(around) - shift)
    size = min(WINDOW, len(item))
    if hi - lo < size:
        return False
    same = np.cumsum(np.r_[0, item[lo:hi] == around[lo + shift:hi + shift]])
    return bool((same[size:] - same[:-size]).max() >= IDENTITY * size)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Distinct doc_id, x (the text's hash) and item_id that overlap."""
    spark = docs.sparkSession
    small_batches(spark)
    found = stored(benchmark_seeds(benchmark), "seeds")
    # bitmap_bucket_number counts from 1, positions from 0: bit v is bit (v - 1) of the array
    shared = spark.sparkContext.broadcast(bitmap(found))
    sizes = found.select(F.least(F.floor(F.length("words") / 2), F.lit(WINDOW)).alias("n")).distinct().collect()
    masks = sorted({mask for r in sizes for mask in masks_of(r["n"])})

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)

        def rows() -> Iterator[dict]:
            for b in it:
                ids, xs = b.column(0).to_pylist(), b.column(1).to_pylist()
                words, ends = flat_hashes(b.column(2))
                own = codes(words)
                for mask in masks:
                    s = seeds(words, mask)
                    at = np.flatnonzero(known(bits, s))
                    doc = np.searchsorted(ends, at, side="right") - 1
                    inside = at + len(mask) <= ends[doc + 1]
                    for p, d in zip(at[inside].tolist(), doc[inside].tolist()):
                        start, end = max(int(ends[d]), p - WINDOW + 1), min(int(ends[d + 1]), p + WINDOW)
                        yield {"seed": int(s[p].view(np.int64)), "doc_id": ids[d], "x": xs[d], "at": p - start,
                               "around": own[start:end].tobytes()}

        yield from batches(rows(), pa.schema([("seed", pa.int64()), ("doc_id", pa.int64()), ("x", pa.int64()), ("at", pa.int32()),
                                              ("around", pa.binary())]))

    hits = docs.select("doc_id", F.xxhash64("text").alias("x"), "text").mapInArrow(run, HITS_DDL)

    def verify(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            item, words, pos, around, at = (b.column(c).to_pylist() for c in ("item_id", "words", "pos", "around", "at"))
            ok = [overlaps(np.frombuffer(words[i], "<u2"), pos[i], np.frombuffer(around[i], "<u2"), at[i]) for i in range(b.num_rows)]
            keep = b.select(["doc_id", "x", "item_id"]).filter(pa.array(ok, pa.bool_()))
            yield keep

    pairs = hits.join(found, "seed").select("doc_id", "x", "item_id", "words", "pos", "around", "at")
    return pairs.mapInArrow(verify, "doc_id bigint, x bigint, item_id bigint").distinct()


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items and item_ids (ascending, comma-joined) of every document."""
    own = contaminations(docs, benchmark).groupBy("doc_id", "x").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_join(F.sort_array(F.collect_list("item_id")).cast("array<string>"), ",").alias("item_ids"))
    d, o = docs.select("doc_id", F.xxhash64("text").alias("x")).alias("d"), own.alias("o")
    return d.join(o, F.expr("d.doc_id <=> o.doc_id and d.x = o.x"), "left").select(
        "d.doc_id", F.col("o.n_items").isNotNull().alias("contaminated"), F.coalesce("o.n_items", F.lit(0)).alias("n_items"),
        F.coalesce("o.item_ids", F.lit("")).alias("item_ids"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap no item."""
    bad = contaminations(docs, benchmark).select("doc_id", "x").distinct().alias("b")
    d = docs.withColumn("_x", F.xxhash64("text")).alias("d")
    return d.join(bad, F.expr("d.doc_id <=> b.doc_id and d._x = b.x"), "left_anti").select(*docs.columns)
