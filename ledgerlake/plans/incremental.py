"""Facts kept up from what a run changed (D1, D2), instead of built anew.

A run changes a fact row for one of three reasons: its source row is new, other
or gone; a dimension version it may point at was opened or closed; or the member
for unknown keys has a new version.  Source rows are told by a hash of the
columns the fact is made of, kept beside the fact's own.  Dimensions tell the
keys whose versions the run opened or closed (``changed_keys``), and only facts
dated from the run on can see those: a run opens and closes versions at its own
time.  The facts found go through the same lookups as in a full build, and the
fact table, kept in key buckets, rewrites the buckets they lie in.

A change of the unknown member, a first build or ``everything=True`` (a new
calendar, a history put right by hand) rebuilds all rows.  Fact keys must not be
null (the fact's own test asks for it); a row without one is left out.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import ts_literal
from ledgerlake.operators.facts import build_fact
from ledgerlake.operators.joins import maybe_broadcast
from ledgerlake.sources.buckets import BucketedTable, Load
from ledgerlake.sources.store import OPEN_SEGMENT, SEGMENT, TableStore
from ledgerlake.spec import SYSTEM_KEY, VALID_FROM, VALID_TO, FactSpec, RunContext

SOURCE_HASH = "source_hash"


def changed_keys(dim: DataFrame, key: str, run_ts: str) -> DataFrame:
    """The keys whose versions the run at ``run_ts`` opened or closed."""
    at = ts_literal(run_ts)
    return dim.filter((F.col(VALID_FROM) == at) | (F.col(VALID_TO) == at)).select(key).filter(F.col(key).isNotNull()).distinct()


def snapshot_feed(store: TableStore, table: str, key: str, ctx: RunContext) -> DataFrame:
    """``changed_keys`` of a stored snapshot: reads the open versions and those this run closed, no older history."""
    rows = store.spark.table(f"{store.db('warehouse')}.{table}").filter(F.col(SEGMENT).isin(OPEN_SEGMENT, f"c{ctx.run_id}"))
    return changed_keys(rows, key, ctx.run_ts)


def source_hash(columns: list[str]) -> Column:
    """64 bits of the columns' values and of which are null."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def source_columns(spec: FactSpec) -> list[str]:
    return list(dict.fromkeys([*spec.attributes, spec.as_of, *(r.fact_key for r in spec.dims)]))


def affected(source: DataFrame, known: DataFrame, feeds: dict[str, DataFrame], spec: FactSpec, run_ts: str) -> DataFrame:
    """The source rows whose fact is not in ``known`` (key and source hash) as it is, or that may see a version that
    the run opened or closed."""
    key = spec.key[0]
    known = known.select(F.col(key).alias("__key"), F.col(SOURCE_HASH).alias("__hash")).distinct()
    same = (F.col(key) == F.col("__key")) & (F.col(SOURCE_HASH) == F.col("__hash"))
    rows = source.join(known, same, "left").withColumn("__hit", F.col("__key").isNull())
    sees = F.col(spec.as_of).cast("timestamp_ntz") >= ts_literal(run_ts)
    for i, ref in enumerate(r for r in spec.dims if r.dim in feeds):
        feed, _ = maybe_broadcast(feeds[ref.dim].select(F.col(ref.dim_key).alias(f"__feed{i}")))
        rows = rows.join(feed, sees & (F.col(ref.fact_key) == F.col(f"__feed{i}")), "left")
        rows = rows.withColumn("__hit", F.col("__hit") | F.col(f"__feed{i}").isNotNull())
    return rows.filter("__hit").select(*source.columns)


def unknown_changed(feeds: dict[str, DataFrame], spec: FactSpec) -> bool:
    return any(not feeds[r.dim].filter(F.col(r.dim_key) == SYSTEM_KEY).isEmpty() for r in spec.dims if r.dim in feeds)


def fact_load(store: TableStore, spec: FactSpec, source: DataFrame, dims: dict[str, DataFrame], feeds: dict[str, DataFrame],
              ctx: RunContext, dim_date: DataFrame | None = None, buckets: int | None = None,
              dim_rows: dict[str, int | None] | None = None, everything: bool = False) -> Load:
    """Bring the stored fact up to this run.  ``feeds``: of each dimension that changed, the keys with versions this
    run opened or closed; ``source``: the staging model as it is now."""
    key = spec.key[0]
    table = BucketedTable(store, "warehouse", spec.name, key, buckets)
    columns = source_columns(spec)
    rows = source.filter(F.col(key).isNotNull()).select(*columns).withColumn(SOURCE_HASH, source_hash(columns))
    known = table.read()
    part = rows
    if known is not None and not everything and not unknown_changed(feeds, spec):
        part = affected(rows, known, feeds, spec, ctx.run_ts)
    hashed = replace(spec, attributes=(*spec.attributes, SOURCE_HASH))
    return table.load(build_fact(part, dims, hashed, dim_date, dim_rows=dim_rows), rows.select(key), live_key=key)


def read_fact(store: TableStore, spec: FactSpec) -> DataFrame | None:
    df = BucketedTable(store, "warehouse", spec.name, spec.key[0]).read()
    return None if df is None else df.drop(SOURCE_HASH)
