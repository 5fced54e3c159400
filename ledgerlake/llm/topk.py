"""Exact top-k by inner product: tiles of queries against blocks of vectors.

Scaled vectors lie in blocks of at most ``BLOCK`` rows, queries in tiles of
about ``TILE``.  Every tile meets every block once: tiles are copied to the
buckets of the blocks and joined there, one matrix product per pair.  Each
product keeps the ``k`` best columns of each query, and lists are merged
``FAN`` at a time until one per tile is left, so no task ever holds more than
a few tiles' lists.

A vector that is null or holds a null or non-finite component takes no part,
nor does a row without id.  Vectors of unlike length don't meet.  Ties go to
the smaller id.  Rows that repeat the query's own id count as its own; every
repeated query row gets a list.  Scores past 64 bits are held at its ends.  An
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored

SCALE = 1024
BLOCK = 8192
TILE = 1024
FAN = 16
LISTS_DDL = "tile bigint, bucket bigint, query_ids binary, ids binary, scores binary"
NONE = np.iinfo(np.int64).min


def scaled(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """place, vec_id, dim and vec (64-bit numbers) of the rows that take part."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for b in it:
            keep, vecs = [], []
            for i, (d, v) in enumerate(zip(b.column(0).to_pylist(), b.column(1))):
                if d is None or not v.is_valid or v.values.null_count:
                    continue
                x = np.floor(SCALE * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(x).all():
                    keep.append(i)
                    vecs.append(np.clip(x, -2.0 ** 62, 2.0 ** 62).astype("<i8"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([place + i for i in range(len(keep))], pa.int64()), b.column(0).take(pa.array(keep, pa.int64())),
                 pa.array([len(v) for v in vecs], pa.int32()), pa.array([v.tobytes() for v in vecs], pa.binary())],
                names=["place", "vec_id", "dim", "vec"])
            place += len(keep)

    return (vectors.select(F.col(id_col).cast("bigint"), F.col(vec_col))
            .mapInArrow(run, "place bigint, vec_id bigint, dim int, vec binary"))


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows of each partition, gathered into blocks of one length."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        made = TaskContext.get().partitionId() << 32

        def block(dim: int, own: list) -> pa.RecordBatch:
            nonlocal made
            made += 1
            own.sort(key=lambda r: r[0])
            return pa.RecordBatch.from_pydict(
                {"block": [made], "dim": [dim], "ids": [np.array([r[0] for r in own], "<i8").tobytes()],
                 "data": [b"".join(r[1] for r in own)]},
                schema=pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())]))

        for b in it:
            for vec_id, dim, vec in zip(*(c.to_pylist() for c in b.columns)):
                own = held.setdefault(dim, [])
                own.append((vec_id, vec))
                if len(own) >= size:
                    yield block(dim, held.pop(dim))
        for dim, own in held.items():
            yield block(dim, own)

    return rows.select("vec_id", "dim", "vec").mapInArrow(run, "block bigint, dim int, ids binary, data binary")


def best_columns(queries: np.ndarray, own: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids and scores of each query's ``k`` best rows; ``ids`` ascend.
    Rows that are missing have the score ``NONE``."""
    out_ids = np.zeros((len(queries), k), np.int64)
    out = np.full((len(queries), k), NONE, np.int64)
    if not len(ids):
        return out_ids, out
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(1, data.shape[1])
    if most * BLOCK >= 2.0 ** 52:
        return exact_columns(queries, own, data, ids, k, out_ids, out)
    n = len(ids)
    # one number orders both score and id, exactly: score first, then column
    key = (queries.astype(np.float64) @ data.astype(np.float64).T) * n + np.arange(n - 1, -1, -1)
    low = -most * n - n
    lo, hi = np.searchsorted(ids, own), np.searchsorted(ids, own, side="right")
    for q in np.flatnonzero(hi > lo):
        key[q, lo[q]:hi[q]] = low * 2 - 1
    m = min(k, n)
    top = np.argpartition(-key, m - 1, axis=1)[:, :m] if m < n else np.tile(np.arange(n), (len(key), 1))
    keys = np.take_along_axis(key, top, 1)
    order = np.argsort(-keys, axis=1)
    top, keys = np.take_along_axis(top, order, 1), np.take_along_axis(keys, order, 1)
    score = np.floor_divide(keys, n).astype(np.int64)
    out_ids[:, :m] = ids[top]
    out[:, :m] = np.where(keys < low, NONE, score)
    return out_ids, out


def exact_columns(queries, own, data, ids, k, out_ids, out):
    """The same by Python's whole numbers, for components too large for floats."""
    rows = [[int(x) for x in r] for r in data]
    for q, (vec, mine) in enumerate(zip(queries, own)):
        v = [int(x) for x in vec]
        scores = ((sum(a * b for a, b in zip(v, r)), int(i)) for r, i in zip(rows, ids) if i != mine)
        held = sorted((-max(NONE + 1, min(s, np.iinfo(np.int64).max)), i) for s, i in scores)[:k]
        for j, (s, i) in enumerate(held):
            out_ids[q, j], out[q, j] = i, -s
    return out_ids, out


def merged(lists: list[tuple[bytes, bytes]], k: int) -> tuple[bytes, bytes]:
    ids = np.concatenate([np.frombuffer(i, "<i8").reshape(-1, k) for i, _ in lists], 1)
    scores = np.concatenate([np.frombuffer(s, "<i8").reshape(-1, k) for _, s in lists], 1)
    # ~score ascends as score falls, without overflow; missing rows come last
    order = np.lexsort((ids, ~scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1).tobytes(), np.take_along_axis(scores, order, 1).tobytes()


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best rows of every query row."""
    spark = vectors.sparkSession
    all_blocks = stored(blocks(scaled(vectors, id_col, vec_col), BLOCK), "vectors")
    queries = scaled(vectors.filter(is_query), id_col, vec_col)
    buckets = max(1, all_blocks.count())
    tiles = max(1, -(-queries.count() // TILE))
    tiled = (queries.groupBy(F.pmod(F.xxhash64("place"), F.lit(tiles)).alias("t"), "dim")
             .agg(F.sort_array(F.collect_list(F.struct("vec_id", "place", "vec"))).alias("own"))
             .select((F.col("t") * F.lit(1 << 20) + F.col("dim")).alias("tile"), "dim", F.col("own.vec_id").alias("query_ids"),
                     F.col("own.vec").alias("queries"),
                     F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))).alias("bucket")))
    pairs = all_blocks.withColumn("bucket", F.pmod(F.xxhash64("block"), F.lit(buckets))).join(tiled, ["dim", "bucket"])

    def product(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i in range(b.num_rows):
                r = {n: b.column(n)[i].as_py() for n in b.schema.names}
                own = np.array(r["query_ids"], "<i8")
                q = np.frombuffer(b"".join(r["queries"]), "<i8").reshape(len(own), r["dim"])
                ids = np.frombuffer(r["ids"], "<i8")
                found, scores = best_columns(q, own, np.frombuffer(r["data"], "<i8").reshape(len(ids), r["dim"]), ids, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["tile"]]), pa.array([r["bucket"]]), *(pa.array([x.astype("<i8").tobytes()]) for x in (own, found, scores))],
                    names=["tile", "bucket", "query_ids", "ids", "scores"])

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for r in b.to_pylist():
                ids, scores = merged([(x["ids"], x["scores"]) for x in r["lists"]], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x]) for x in (r["tile"], r["bucket"], r["query_ids"], ids, scores)],
                    names=["tile", "bucket", "query_ids", "ids", "scores"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    lists = pairs.select("tile", "bucket", "dim", "ids", "data", "query_ids", "queries").mapInArrow(product, LISTS_DDL)
    lists = stored(lists, "lists")
    while True:
        lists = (lists.groupBy("tile", F.floor(F.col("bucket") / FAN).alias("bucket"))
                 .agg(F.first("query_ids").alias("query_ids"), F.collect_list(F.struct("ids", "scores")).alias("lists"))
                 .mapInArrow(merge, LISTS_DDL))
        buckets = -(-buckets // FAN)
        if buckets <= 1:
            break
        lists = stored(lists, "lists")

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for r in b.to_pylist():
                own = np.frombuffer(r["query_ids"], "<i8")
                ids, scores = (np.frombuffer(r[c], "<i8").reshape(-1, k) for c in ("ids", "scores"))
                q, rank = np.nonzero(scores != NONE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[q]), pa.array(rank + 1, pa.int32()), pa.array(ids[q, rank]), pa.array(scores[q, rank])],
                    names=["query_id", "rank", "vec_id", "score"])

    return lists.mapInArrow(rows, "query_id bigint, rank int, vec_id bigint, score bigint")
