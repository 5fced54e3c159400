"""Token ids in files, Huffman coded from global counts.

``write_ids`` tokenizes every text, counts ids over all documents, derives a
canonical code of at most 16 bits by package-merge, and writes shards in
ascending document order, by name.  A file row is a group of whole documents: their ids
and lengths, the coded payload, and the bit offset at which each block of
``BLOCK`` ids starts.  Blocks need nothing but the code's lengths, so a reader
may start at any of them.  ``read_ids`` decodes all blocks of a group side by
side from one 65,536-entry table.

Null texts count as empty (one id, the end id).  Rows order by doc_id (nulls
first) and then text, so repeated rows stay rows of their own in a fixed
order.  An empty table gives files without rows.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, partitions, small_batches, stored
from ledgerlake.llm.tokens import TEXTS, encoder
from ledgerlake.session import new_scratch_path

MAX_BITS = 16
BLOCK = 512
GROUP_IDS = 1_000_000
# Ids coded at once, whole blocks of them.
PACKED = 32 * BLOCK
END_ID = 2

GROUPS = pa.schema([
    ("run", pa.string()), ("shard", pa.int32()), ("group", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())), ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary())])
GROUPS_DDL = ("run string, shard int, group int, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, "
              "checkpoints array<bigint>, payload binary")


@dataclass(frozen=True)
class Code:
    """Canonical code: ``lengths`` in bits by id (0: the id never occurs)."""

    lengths: np.ndarray
    words: np.ndarray

    @staticmethod
    def of_lengths(lengths: np.ndarray) -> Code:
        words, word, used = np.zeros(len(lengths), np.uint64), 0, 0
        for i in np.lexsort((np.arange(len(lengths)), lengths)):
            if n := int(lengths[i]):
                word <<= n - used
                words[i], used = word, n
                word += 1
        return Code(lengths.astype(np.int64), words)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """For every 16-bit window: the id it starts with, and its bits."""
        ids, bits = np.zeros(1 << MAX_BITS, np.uint16), np.ones(1 << MAX_BITS, np.uint8)
        for i in np.flatnonzero(self.lengths):
            n = int(self.lengths[i])
            lo = int(self.words[i]) << (MAX_BITS - n)
            ids[lo:lo + (1 << (MAX_BITS - n))] = i
            bits[lo:lo + (1 << (MAX_BITS - n))] = n
        return ids, bits


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits, by package-merge: in each
    round the cheapest symbols and pairs are paired; the 2n-2 cheapest items of
    the last round, followed back, give a symbol one bit for each time it
    occurs."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} symbols need more than {most} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    rounds, pairs = [], np.zeros(0)
    for _ in range(most):
        items = np.concatenate([weights, pairs])
        order = np.argsort(items, kind="stable")
        rounds.append(order < len(weights))
        items = items[order]
        pairs = items[0:len(items) // 2 * 2:2] + items[1::2][:len(items) // 2]
    take = 2 * len(used) - 2
    for leaf in reversed(rounds):
        symbols = int(leaf[:take].sum())
        lengths[used[:symbols]] += 1
        take = 2 * (take - symbols)
    return lengths


def pack(ids: np.ndarray, code: Code) -> tuple[bytes, np.ndarray]:
    """The coded bits, and where each block starts."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    out = np.zeros(len(ids) * MAX_BITS // 32 + 2, np.uint64)
    starts, begin = [], 0
    for s in range(0, len(ids), PACKED):  # few enough for a processor's cache
        own = ids[s:s + PACKED]
        bits = code.lengths[own]
        until = np.cumsum(bits) + begin
        at = until - bits
        frame = code.words[own] << (64 - (at & 31) - bits).astype(np.uint64)
        word = at >> 5
        edges = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out[word[edges]] += np.add.reduceat(frame >> np.uint64(32), edges)
        out[word[edges] + 1] += np.add.reduceat(frame & np.uint64(0xFFFFFFFF), edges)
        starts.append(at[::BLOCK])
        begin = int(until[-1])
    return out[:(int(at[-1]) >> 5) + 2].astype(">u4").tobytes(), np.concatenate(starts)


def unpack(payload: bytes, checkpoints: np.ndarray, n_ids: int,
           table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids of a group; every block advances by one id in each step."""
    if not n_ids:
        return np.zeros(0, np.uint16)
    ids_of, bits_of = table
    b = np.frombuffer(payload + b"\0\0\0", np.uint8).astype(np.uint32)
    window = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    at, last = checkpoints.astype(np.int64), len(window) - 1
    out = np.empty((min(BLOCK, n_ids), len(at)), np.uint16)
    for step in range(len(out)):
        peek = (window[np.minimum(at >> 3, last)] >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
        out[step] = ids_of[peek]
        at += bits_of[peek]
    return out.T.reshape(-1)[:n_ids]


def tokenized(docs: DataFrame, vocabulary: Callable[[], str] | str, end_id: int = END_ID) -> DataFrame:
    """doc_id and ids (little-endian 16-bit numbers, end id included), in
    ascending order over the partitions; and, apart (``counts``), a row for
    each partition with how often it holds each of the 65,536 possible ids."""
    spark = docs.sparkSession
    small_batches(spark, TEXTS)
    n = partitions(spark)
    rows = docs.select("doc_id", "text").repartitionByRange(n, "doc_id", F.xxhash64("text"))
    rows = rows.sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u2")

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary() if callable(vocabulary) else vocabulary, False)
        part, n = TaskContext.get().partitionId(), 0
        total = np.zeros(1 << 16, np.int64)
        for b in it:
            ids = [np.concatenate([x, end]).tobytes() for x in e.encode(b.column(1))]
            total += np.bincount(np.frombuffer(b"".join(ids), "<u2"), minlength=1 << 16)
            rows = len(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([part] * rows, pa.int32()), pa.array(range(n, n + rows), pa.int64()),
                 pa.array(ids, pa.binary()), pa.array([False] * rows)], names=["doc_id", "shard", "place", "ids", "counts"])
            n += rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()]),
             pa.array([True])], names=["doc_id", "shard", "place", "ids", "counts"])

    return rows.mapInArrow(encode, "doc_id bigint, shard int, place bigint, ids binary, counts boolean")


def id_counts(counted: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents, from the partitions' counts."""
    def spread(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            total = sum((np.frombuffer(x, "<i8") for x in b.column(0).to_pylist()), np.zeros(1 << 16, np.int64))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])

    counts = np.zeros(1 << 16, np.int64)
    for r in counted.select("ids").mapInArrow(spread, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    return counts


def write_ids(docs: DataFrame, vocabulary: Callable[[], str] | str, path: str | None = None,
              end_id: int = END_ID) -> tuple[str, Code]:
    """Writes the groups under ``path`` and the code's lengths beside them."""
    spark = docs.sparkSession
    path = path or new_scratch_path(spark, "token-ids")
    path_of_ids = new_scratch_path(spark, "ids")
    # not partitioned by ``counts``: such a write sorts each task by it, and a sort that spills
    # does not keep the order of the documents
    tokenized(docs, vocabulary, end_id).write.parquet(path_of_ids)
    small_batches(spark)
    both = spark.read.schema("doc_id bigint, shard int, place bigint, ids binary, counts boolean").parquet(path_of_ids)
    tokens = both.filter(~F.col("counts")).drop("counts")
    code = Code.of_lengths(code_lengths(id_counts(both.filter("counts"))))

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[dict]:
            held: list[tuple[int | None, bytes]] = []
            size, shard, group, run = 0, None, 0, ""
            for b in it:
                for doc_id, s, place, ids in zip(*(c.to_pylist() for c in b.columns)):
                    # a group is documents without a gap, so that its start is the sum of those before it
                    gap = s != shard or place != group + len(held)
                    if held and (gap or size >= GROUP_IDS):
                        yield row(held, shard, group, run)
                        held, size = [], 0
                    if gap:  # a run has a directory of its own, and their names ascend with the documents
                        shard, run = s, f"{s:06d}-{place:012d}"
                    if not held:
                        group = place
                    held.append((doc_id, ids))
                    size += len(ids) // 2
            if held:
                yield row(held, shard, group, run)

        def row(held: list, shard: int, group: int, run: str) -> dict:
            ids = np.frombuffer(b"".join(x for _, x in held), "<u2")
            payload, checkpoints = pack(ids, code)
            return {"run": run, "shard": shard, "group": group, "n_ids": len(ids), "doc_ids": [d for d, _ in held],
                    "lengths": [len(x) // 2 for _, x in held], "checkpoints": checkpoints, "payload": payload}

        yield from batches(groups(), GROUPS, 1)

    # Spark deals out the ids' files as it likes; the runs keep each task's documents apart
    groups = tokens.mapInArrow(encode, GROUPS_DDL).sortWithinPartitions("run", "group")
    groups.write.partitionBy("run").parquet(f"{path}/groups")
    spark.createDataFrame([(code.lengths.tolist(),)], "lengths array<bigint>").coalesce(1).write.parquet(f"{path}/code")
    return path, code


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document of the files."""
    small_batches(spark, 4)
    groups = spark.read.schema(GROUPS_DDL).parquet(f"{path}/groups").drop("run")
    lengths = np.array(spark.read.parquet(f"{path}/code").head()["lengths"], np.int64)
    out = pa.schema([("shard", pa.int32()), ("group", pa.int32()), ("doc_id", pa.int64()), ("inside", pa.int64()),
                     ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
                    + [("ids", pa.list_(pa.int64()))] * with_ids)

    def decode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Code.of_lengths(lengths).table()

        def docs() -> Iterator[dict]:
            for b in it:
                for i in range(b.num_rows):
                    g = {name: b.column(name)[i].as_py() for name in ("shard", "group", "n_ids", "doc_ids", "lengths", "payload")}
                    ids = unpack(g["payload"], b.column("checkpoints")[i].values.to_numpy(), g["n_ids"], table).astype("<u4")
                    at = 0
                    for doc_id, n in zip(g["doc_ids"], g["lengths"]):
                        own = ids[at:at + n]
                        yield {"shard": g["shard"], "group": g["group"], "doc_id": doc_id, "inside": at, "n_tokens": n,
                               "ids_crc32": zlib.crc32(own.tobytes())} | ({"ids": own.astype(np.int64)} if with_ids else {})
                        at += n

        yield from batches(docs(), out, 128 if with_ids else 4096)

    read = groups.mapInArrow(decode, "shard int, group int, doc_id bigint, inside bigint, n_tokens bigint, "
                             "ids_crc32 bigint" + ", ids array<bigint>" * with_ids)
    # where groups start: sums inside each shard, then over the shards (one row each)
    sizes = groups.select("shard", "group", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    own = Window.partitionBy("shard").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(own), F.lit(0)))
              .join(shards, "shard").select("shard", "group", (F.col("shard_start") + F.col("before")).alias("base")))
    return read.join(starts, ["shard", "group"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
