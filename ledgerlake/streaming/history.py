"""Version history as a stream (V1-V8 without a merge job).

Landed states of one source (each with the time of the run that saw it) flow
through a stateful operator that keeps the open version of every key.  A state
whose check columns differ (null-safe) closes the open version and opens a new
one at its run's time, one without a difference changes nothing (unchecked
columns stay frozen), and a tombstone closes the open version.  What comes out
is append-only: an ``open`` row when a version begins and a ``close`` row when
it ends.  ``history_of`` puts both together into the rows of ``scd2_merge``.

Tombstones come from the live-id audit: ``changes_between`` compares the ids of
two landed states and marks what is gone.

Order and lateness: states of a key are taken by run time, within a micro-batch
too.  A state of a run that is not after the key's last one is late; it cannot
be put into a history that is written already, so it changes nothing and comes
out as a ``late`` row (a replayed file is late throughout).  A state that lands
before an earlier run's is therefore a version, and the earlier one late; a
source that lands runs out of order must be replayed in order from bronze.

Keys: a null key matches nothing and is dropped, as in the merge.  Two states of
one key in one run are refused by the merge's guard; here the greater row counts
(by its columns in order) and the other is late.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ledgerlake.functions.scalar import scd_key, ts_literal
from ledgerlake.spec import DK, OPEN_END, UPDATED_AT, VALID_FROM, VALID_TO, SnapshotSpec

RUN = "run_micros"            # time of the run that saw the state, in microseconds of UTC
GONE = "gone"                 # a tombstone: the key is not in the source any more
EVENT = "event"               # open | close | late
AT = "at_micros"              # when the version begins or ends
# Keys that share a state by their hash, so that Python is not called once for each key.  A checkpoint holds states by
# bucket, so the number stays.
BUCKETS = 1 << 14


def changes_between(before: DataFrame | None, now: DataFrame, key: str, run_ts: str) -> DataFrame:
    """What a run lands: all states it saw, and a tombstone of each key that the run before had and this one has not."""
    run = F.unix_micros(ts_literal(run_ts).cast("timestamp"))
    states = now.withColumns({RUN: run, GONE: F.lit(False)})
    if before is None:
        return states
    lost = before.join(now.select(key), key, "left_anti").select(key)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in now.schema.fields if f.name != key]
    tombs = lost.select(F.col(key), *nothing).select(*now.columns).withColumns({RUN: run, GONE: F.lit(True)})
    return states.unionByName(tombs)


def initial_changes(now: DataFrame, updated_at: str = "last_edited_time") -> DataFrame:
    """What an initial load lands: each state begins at its own ``updated_at`` (V7)."""
    return now.withColumns({RUN: F.unix_micros(F.col(updated_at).cast("timestamp")), GONE: F.lit(False)})


def land(changes: DataFrame, landed: str, run_id: int) -> None:
    changes.write.mode("overwrite").parquet(f"{landed}/run_id={run_id}")


def events(changes: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """The open, close and late rows of a stream (or table) of changes."""
    data = [f for f in changes.schema.fields if f.name not in (RUN, GONE, "run_id")]
    names = [f.name for f in data]
    # the state of a bucket: of each of its keys the last run, and the open version with the time it began (both null
    # without one); pickled, so that values stay as they are
    state = StructType([StructField("keys", BinaryType())])
    out = StructType([*data, StructField(EVENT, StringType()), StructField(AT, LongType()), StructField("began", LongType())])
    own, check = names.index(spec.key), [names.index(c) for c in spec.check_cols]
    blank = (None,) * len(names)

    def run(bucket: tuple, batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        keys = pickle.loads(bytes(kept.get[0])) if kept.exists else {}
        by_key: dict[Any, list[tuple]] = {}
        for b in batches:
            for at, gone, *values in zip(*(b[c].tolist() for c in (RUN, GONE, *names))):
                values = tuple(map(plain, values))
                by_key.setdefault(values[own], []).append((int(at), bool(gone), values))
        emitted: list[tuple] = []
        for key, rows in by_key.items():
            keys[key] = fold(rows, *keys.get(key, (None, None, blank)), emitted)
        kept.update((pickle.dumps(keys, pickle.HIGHEST_PROTOCOL),))
        yield pd.DataFrame(emitted, columns=out.names, dtype=object)

    def fold(rows: list[tuple], last: int | None, began: int | None, version: tuple, emitted: list[tuple]) -> tuple:
        """The state of a key after some rows; their events go to ``emitted``."""
        if len(rows) > 1:
            rows.sort(key=lambda r: tuple((v is not None, str(v)) for v in r[2]), reverse=True)
            rows.sort(key=lambda r: r[:2])
        for at, gone, values in rows:
            if last is not None and at <= last:
                emitted.append((*values, "late", at, None))
                continue
            last = at
            if gone or (began is not None and any(version[i] != values[i] for i in check)):
                if began is not None:
                    emitted.append((*version, "close", at, began))
                began, version = None, blank
            if not gone and began is None:
                began, version = at, values
                emitted.append((*version, "open", at, at))
        return last, began, version

    keyed = changes.filter(F.col(spec.key).isNotNull()).withColumn("__bucket", F.pmod(F.xxhash64(spec.key), F.lit(BUCKETS)))
    return keyed.groupBy("__bucket").applyInPandasWithState(run, out, state, "append", GroupStateTimeout.NoTimeout)


def plain(v: Any) -> Any:
    """A cell as Python keeps it: pandas' missing values are None, its numbers and times are Python's."""
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    return v.to_pydatetime() if isinstance(v, pd.Timestamp) else v


def start_history(spark, landed: str, schema: StructType, spec: SnapshotSpec, out: str, checkpoint: str,
                  files_per_trigger: int | None = None) -> StreamingQuery:
    """Read what has landed, in order of landing, and append the events; ends when all is read.  The checkpoint holds
    the files read and the state; the sink's log makes each micro-batch's rows appear once."""
    r = spark.readStream.schema(StructType([*schema.fields, StructField("run_id", LongType())]))
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    rows = events(r.parquet(landed).drop("run_id"), spec)
    return (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())


def history_of(rows: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """The versions that the events tell of: each ``open`` row, ended by the ``close`` row of the same version."""
    data = [c for c in rows.columns if c not in (EVENT, AT, "began")]
    time = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    ends = rows.filter(F.col(EVENT) == "close").select(F.col(spec.key).alias("__k"), F.col("began").alias("__b"), F.col(AT).alias("__end"))
    opened = rows.filter(F.col(EVENT) == "open")
    both = opened.join(ends, (F.col(spec.key) == F.col("__k")) & (F.col(AT) == F.col("__b")), "left")
    began = time(F.col(AT))
    end: Column = F.coalesce(time(F.col("__end")), ts_literal(OPEN_END))
    return both.select(*data, scd_key(F.col(spec.key), began).alias(DK), began.alias(UPDATED_AT), began.alias(VALID_FROM), end.alias(VALID_TO))
