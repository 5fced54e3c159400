"""Run statistics (T1-T4, K5): the ``sys_etl_stats`` table, keyed by
``(run_id, dag_name, task_name)``, with one counter column per step.

Counts are aggregates computed on the executors; the table update is a full
outer join on the key with ``coalesce(new, old)`` for the one counter, so any
number of (run, task) rows are upserted in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from ledgerlake.functions.scalar import ts_literal
from ledgerlake.spec import SYSTEM_KEY, VALID_FROM, VALID_TO

COUNTERS = ("ntn_extracted", "raw_loaded", "raw_deleted", "wh_loaded", "wh_closed")
KEY = ("run_id", "dag_name", "task_name")
STATS_SCHEMA = StructType([
    StructField("run_id", LongType()), StructField("run_date", DateType()),
    StructField("dag_name", StringType()), StructField("task_name", StringType()),
    *[StructField(c, LongType()) for c in COUNTERS]])


def empty_stats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATS_SCHEMA)


def count_as(df: DataFrame, run_id: int, run_date: str, dag_name: str, task_name: str) -> DataFrame:
    """One update row: ``count(*)`` of ``df`` for (run, dag, task)."""
    return df.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(run_id).cast("bigint").alias("run_id"), F.lit(run_date).cast("date").alias("run_date"),
        F.lit(dag_name).alias("dag_name"), F.lit(task_name).alias("task_name"), "value")


def upsert_counter(stats: DataFrame, updates: DataFrame, column: str) -> DataFrame:
    """Set ``column`` from ``updates`` (run_id, run_date, dag_name, task_name,
    value) where the key exists; insert a row with only that counter
    otherwise (K5)."""
    if column not in COUNTERS:
        raise ValueError(f"unknown counter {column!r}")
    u = updates.select(*[F.col(k).alias(f"u_{k}") for k in (*KEY, "run_date")], F.col("value").alias("u_value"))
    cond = None
    for k in KEY:
        c = F.col(k) == F.col(f"u_{k}")
        cond = c if cond is None else cond & c
    j = stats.join(u, cond, "full_outer")
    matched_or_new = F.col("u_run_id").isNotNull()
    return j.select(
        F.coalesce(F.col("run_id"), F.col("u_run_id")).alias("run_id"),
        F.coalesce(F.col("run_date"), F.col("u_run_date")).alias("run_date"),
        F.coalesce(F.col("dag_name"), F.col("u_dag_name")).alias("dag_name"),
        F.coalesce(F.col("task_name"), F.col("u_task_name")).alias("task_name"),
        *[(F.when(matched_or_new, F.col("u_value")).otherwise(F.col(c)) if c == column else F.col(c))
          .cast("bigint").alias(c) for c in COUNTERS])


def update_by_task(stats: DataFrame, updates: DataFrame, run_id: int, column: str) -> DataFrame:
    """T4: set ``column`` on existing rows of ``run_id`` whose task_name is in
    ``updates`` (task_name, value); ``dag_name`` is not compared and nothing
    is inserted."""
    u = updates.select(F.col("task_name").alias("u_task"), F.col("value").alias("u_value"))
    j = stats.join(u, (F.col("task_name") == F.col("u_task")) & (F.col("run_id") == F.lit(run_id)), "left")
    return j.select(*[
        (F.when(F.col("u_task").isNotNull(), F.col("u_value")).otherwise(F.col(c)).cast("bigint").alias(c)
         if c == column else F.col(c)) for c in stats.columns])


def window_between(run_ts: str, minutes: int = 2):
    """(from, to) of the "this run" window: [run_ts - minutes, run_ts]."""
    to = ts_literal(run_ts)
    return to - F.expr(f"INTERVAL {minutes} MINUTES"), to


def wh_loaded(snapshot: DataFrame, lo, hi) -> DataFrame:
    """Versions whose valid_from lies in [lo, hi] (inclusive)."""
    return snapshot.filter(F.col(VALID_FROM).between(lo, hi)).agg(F.count(F.lit(1)).alias("value"))


def wh_closed(snapshot: DataFrame, key: str, live_ids: DataFrame, lo, hi) -> DataFrame:
    """Distinct keys closed in [lo, hi], not the system member, and not
    live any more (set difference, so a changed key is not counted)."""
    closed = (snapshot.filter((F.col(key) != F.lit(SYSTEM_KEY)) & F.col(VALID_TO).between(lo, hi))
                      .select(F.col(key).alias("k")))
    live = live_ids.select(F.col("id").alias("k"))
    return closed.subtract(live).agg(F.count(F.lit(1)).alias("value"))


def task_name(entity: str) -> str:
    return f"extract_and_load_{entity}"
