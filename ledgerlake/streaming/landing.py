"""Continuous ingestion of landed response files (S1 + K2 as a stream).

The reference polls its source on a schedule with a stored watermark.  Here
the landed response directory is a Structured Streaming file source: each
micro-batch holds the pages of newly arrived files, and ``foreachBatch``
upserts them into the raw table.  The stream checkpoint records which files
were processed; the upsert is idempotent (replace by key), so a batch replayed
after a failure gives the same table.  The hard-delete sync needs the full
live-id set and stays in the batch job (``plans.jobs.entity_load``).

Two sinks:

* ``start_ingest``: foreachBatch upsert into the versioned raw table (each
  micro-batch publishes a new raw version; for small tables or long triggers).
  A micro-batch may hold several landed states of one page; only the latest
  (by ``last_edited_time``) is upserted, as one source pull would return it;
* ``start_bronze_append``: the built-in CSV file sink appends mapped rows to
  the bronze layer, partitioned by the micro-batch's run id.  Append-only, so
  its cost grows with the new rows, not with the table; its metadata log makes
  it exactly-once.  ``sources.bronze.replay`` rebuilds the raw state from it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.load import latest_per_key, source_filter, upsert
from ledgerlake.sources.bronze import CSV_OPTIONS
from ledgerlake.sources.pages import map_pages, response_schema
from ledgerlake.sources.store import TableStore
from ledgerlake.spec import EntitySpec


def page_stream(spark, landed: str, spec: EntitySpec, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(response_schema(spec.props))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.option("mode", "FAILFAST").json(landed).select(F.explode("results").alias("p")).select("p.*")


def upsert_batch(store: TableStore, spec: EntitySpec, run_ts: str | None = None):
    """foreachBatch body: map, filter and upsert one micro-batch.  Without
    ``run_ts`` its load time is its own; a state older than the stored one
    (it landed late) is left out, and a batch without news writes nothing."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        ts = run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        # a micro-batch may hold several landed states of one page: keep the latest
        rows = latest_per_key(source_filter(map_pages(batch, spec, ts), spec), spec.key,
                              ["last_edited_time"], one_per_key=True)
        raw = store.read("raw", spec.name)
        if raw is not None:
            stored = raw.select(F.col(spec.key).alias("__k"), F.col("last_edited_time").alias("__t"))
            rows = rows.join(stored, (F.col(spec.key) == F.col("__k")) & (F.col("__t") > F.col("last_edited_time")), "left_anti")
            if rows.isEmpty():
                return
        target = raw if raw is not None else store.spark.createDataFrame([], rows.schema)
        store.publish(upsert(target, rows), "raw", spec.name)
    return run


def start_ingest(store: TableStore, spec: EntitySpec, landed: str, checkpoint: str, run_ts: str | None = None,
                 trigger_once: bool = False, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``trigger_once`` processes what is there and stops."""
    w = (page_stream(store.spark, landed, spec, max_files_per_trigger).writeStream
         .foreachBatch(upsert_batch(store, spec, run_ts))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()


def start_bronze_append(spark, spec: EntitySpec, landed: str, bronze_entity_dir: str, checkpoint: str,
                        trigger_once: bool = False, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append each micro-batch's mapped, filtered rows under
    ``<bronze_entity_dir>/run_id=<micro-batch time in microseconds>/`` (a
    finer run id than the batch jobs' yyyyMMddHHmmss, so two micro-batches in
    one second still replay in order)."""
    batch_ts = F.current_timestamp()          # one value per micro-batch
    rows = (source_filter(map_pages(page_stream(spark, landed, spec, max_files_per_trigger), spec,
                                    "1970-01-01 00:00:00"), spec)
            .withColumn("load_date", batch_ts.cast("timestamp_ntz"))
            .withColumn("run_id", F.unix_micros(batch_ts)))
    w = (rows.writeStream.format("csv").options(**CSV_OPTIONS).partitionBy("run_id")
             .option("path", bronze_entity_dir).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()
