"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import new_scratch_path

# Rows of one Arrow batch.  Texts may be long, so batches are kept short; this
# bounds a Python worker's memory and changes no result.
ARROW_ROWS = 256
ARROW_BYTES = 32 << 20
# Text that is worked on at once where whole blocks are counted (see ``blocks``).
BLOCK_BYTES = 6 << 20


def release() -> None:
    """Give freed memory back to the system: Arrow and the C library keep it else, and the driver's Python shares its
    memory limit with the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    with files that outlive any executor."""
    path = new_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id's decimal text, modulo ``k`` (null ids: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(k)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def blocks(it: Iterator[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches gathered until the column holds ``most`` bytes: what is counted
    or looked up by block is done less often.  Empty batches are left out."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in it:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.column(column).nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """Marked for a broadcast if it is counted to hold at most ``rows`` rows;
    else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Column lists, gathered into record batches of at least ``size`` rows."""
    held: dict[str, list] = {f.name: [] for f in schema}
    for row in rows:
        for k, v in row.items():
            held[k].append(v)
        if len(held[schema[0].name]) >= size:
            yield pa.RecordBatch.from_pydict(held, schema=schema)
            held = {f.name: [] for f in schema}
    if held[schema[0].name]:
        yield pa.RecordBatch.from_pydict(held, schema=schema)
