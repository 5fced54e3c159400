"""Jobs (R1-R4): the steps of a run, against a ``TableStore``.

Only the watermark, row counts and check results reach the driver; every
step over data is a Spark plan.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import quality as Q
from ledgerlake.operators import stats as S
from ledgerlake.operators.load import (EmptyLiveSet, incremental, reset_dates, source_filter, sync_deletes, upsert,
                                       watermark_value)
from ledgerlake.operators.scd2 import scd2_changes, scd2_merge
from ledgerlake.plans.specs import ENTITY_ORDER, FACTS, SNAPSHOTS, STAGING, STAGING_CHECKS, WAREHOUSE_CHECKS
from ledgerlake.plans.warehouse import build_facts, stage_all
from ledgerlake.session import drop_path, new_scratch_path, release_shuffles, scratch_dir
from ledgerlake.sources.bronze import write_bronze
from ledgerlake.sources.buckets import BucketedTable, Load
from ledgerlake.sources.pages import map_pages, read_pages, require_complete
from ledgerlake.sources.store import COMPRESSION, TableStore
from ledgerlake.spec import EntitySpec, RunContext

AUDIT_TABLE = "ids_audit"
FAILURES_SCHEMA = "test_failures"          # one table of failing rows per data test
STATS_TABLE = "sys_etl_stats"
LARGE_ROWS = 500_000                       # raw rows of an entity whose steps run alone
SLICE_ROWS = 500_000                       # rows of a slice of a snapshot's keys; each slice reads its tables again,
MAX_SLICES = 8                             # so there are no more than these


@dataclass
class LoadCounts:
    entity: str
    extracted: int
    loaded: int
    deleted: int


def _stats(store: TableStore) -> DataFrame:
    return store.read_or_empty("warehouse", STATS_TABLE, S.STATS_SCHEMA)


def record_counts(store: TableStore, ctx: RunContext, counts: list[tuple[str, str, int]]) -> None:
    """Upsert (task, counter, value) triples into ``sys_etl_stats`` (K5)."""
    spark = store.spark
    stats = _stats(store)
    for counter in dict.fromkeys(c for _, c, _ in counts):
        rows = [(ctx.run_id, ctx.run_ts[:10], ctx.dag_name, t, v) for t, c, v in counts if c == counter]
        upd = spark.createDataFrame(rows, "run_id bigint, run_date string, dag_name string, task_name string, "
                                          "value bigint").withColumn("run_date", F.col("run_date").cast("date"))
        stats = S.upsert_counter(stats, upd, counter)
    store.publish(stats, "warehouse", STATS_TABLE)


def replace_audit_slice(store: TableStore, entity: str, live: DataFrame) -> None:
    """Replace one entity's slice of the live-id table (K4), atomically: the
    new slice is written to its own directory, then only the partition
    ``source_name=<entity>`` is repointed at it.  Readers see the old or the
    new slice, never none; an empty slice empties the partition."""
    spark = store.spark
    name = f"{store.db('raw')}.{AUDIT_TABLE}"
    base = f"{store.root}/raw/{AUDIT_TABLE}"
    if not store.exists("raw", AUDIT_TABLE):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (id STRING, title STRING, source_name STRING) USING parquet "
                  f"PARTITIONED BY (source_name) LOCATION '{base}/_table'")
    path = f"{base}/source_name={entity}/v={uuid.uuid4().hex}"
    live.select("id", "title").write.option("compression", COMPRESSION).parquet(path)
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    if f"source_name={entity}" in known:
        spark.sql(f"ALTER TABLE {name} PARTITION (source_name = '{entity}') SET LOCATION '{path}'")
    else:
        spark.sql(f"ALTER TABLE {name} ADD PARTITION (source_name = '{entity}') LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def entity_load(store: TableStore, spec: EntitySpec, landed: str, ctx: RunContext,
                bronze_root: str | None = None, record: bool = True, allow_empty: bool = False) -> LoadCounts:
    """Watermark -> incremental read -> bronze -> upsert -> live ids ->
    hard-delete sync -> stats, for one entity.

    An unreadable or incomplete pull raises before anything is written, and so
    does an empty one that would delete every raw row, unless ``allow_empty``.
    A run that changes nothing writes no new version.

    The landed pages are the source's current state; they are parsed once and
    their rows kept in the scratch folder (columns, a fraction of what a cache
    spills) while both the incremental batch and the live-id set are taken
    from them.
    """
    spark = store.spark
    scratch_dir(spark)
    require_complete(spark, landed, spec)
    raw = store.read("raw", spec.name)
    known, wm = store.watermark("raw", spec.name)       # recorded at write time: no scan
    if not known:
        wm = watermark_value(raw)
    mapped = source_filter(map_pages(read_pages(spark, landed, spec), spec, ctx.run_ts), spec)
    kept_at = new_scratch_path(spark, f"mapped-{spec.name}")
    try:
        mapped.write.option("compression", COMPRESSION).parquet(kept_at)
        mapped = spark.read.schema(mapped.schema).parquet(kept_at)
        batch = incremental(mapped, "last_edited_time", wm)
        n = batch.count()
        if not allow_empty and (store.rows("raw", spec.name) or 0) and mapped.isEmpty():
            raise EmptyLiveSet(f"{spec.name}: the pull holds no page; pass allow_empty=True to delete every row")
        if bronze_root and n:
            write_bronze(batch, bronze_root, spec.name, ctx.run_id)
        replace_audit_slice(store, spec.name, mapped.select("id", "title"))
        target = raw if raw is not None else spark.createDataFrame([], batch.schema)
        upserted = upsert(target, batch, batch_rows=n)
        audit = store.read("raw", AUDIT_TABLE).filter(F.col("source_name") == spec.name)
        raw_rows = store.rows("raw", spec.name) or 0
        kept, deleted = sync_deletes(upserted, audit, spec.key, target_rows=raw_rows + n)
        if n or deleted or raw is None:
            store.publish(kept, "raw", spec.name)
    finally:
        drop_path(spark, kept_at)
    counts = LoadCounts(spec.name, n, n, deleted)
    if record:
        record_counts(store, ctx, load_count_rows([counts]))
    return counts


def bucketed_entity_load(store: TableStore, spec: EntitySpec, landed: str, ctx: RunContext, buckets: int | None = None,
                         record: bool = True, allow_empty: bool = False) -> tuple[LoadCounts, Load]:
    """R1 with the raw table kept in key buckets (``sources.buckets``): the same rows as ``entity_load``, but the
    upsert and the delete sync are one step that writes only the buckets with news.  The raw table is bucketed from
    its first load on; ``buckets`` is chosen from its size unless given."""
    spark = store.spark
    scratch_dir(spark)
    require_complete(spark, landed, spec)
    table = BucketedTable(store, "raw", spec.name, spec.key, buckets)
    wm = table.watermark()
    mapped = source_filter(map_pages(read_pages(spark, landed, spec), spec, ctx.run_ts), spec)
    mapped = mapped.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        batch = incremental(mapped, "last_edited_time", wm)
        n = batch.count()
        replace_audit_slice(store, spec.name, mapped.select("id", "title"))
        audit = store.read("raw", AUDIT_TABLE).filter(F.col("source_name") == spec.name)
        done = table.load(batch, audit, batch_rows=n, allow_empty=allow_empty or not table.rows())
    finally:
        mapped.unpersist()
    counts = LoadCounts(spec.name, n, n, done.deleted)
    if record:
        record_counts(store, ctx, load_count_rows([counts]))
    return counts, done


def load_count_rows(loads: list[LoadCounts]) -> list[tuple[str, str, int]]:
    out = []
    for c in loads:
        task = S.task_name(c.entity)
        out += [(task, "ntn_extracted", c.extracted), (task, "raw_loaded", c.loaded), (task, "raw_deleted", c.deleted)]
    return out


@dataclass
class BuildResult:
    published: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    failed_checks: list[str] = field(default_factory=list)
    summaries: list[list] = field(default_factory=list)


def run_checks(store: TableStore, checks, tables: dict[str, DataFrame], result: BuildResult,
               rows: dict[str, int | None] | None = None) -> set[str]:
    """Q10 + K9: summarise the checks (a job for each table, so that one
    table's keys are shuffled at a time), store the failing rows of each
    failing check under ``test_failures``, return the tables with a failed
    error-severity check."""
    checks = [c for c in checks if c.table in tables and (c.parent is None or c.parent in tables)]
    if not checks:
        return set()
    summary_rows = []
    for t in dict.fromkeys(c.table for c in checks):
        summary_rows += Q.summary([c for c in checks if c.table == t], tables, rows).collect()   # one row per check
        release_shuffles(store.spark)
    result.summaries.append(summary_rows)
    bad = {r["test_name"]: r["status"] for r in summary_rows if r["failures"] > 0}
    by_name = {c.name: c for c in checks}
    for c in checks:
        # a passing check empties a failures table left by an earlier run
        if c.name in bad or store.exists(FAILURES_SCHEMA, c.name):
            store.publish(Q.failures(c, tables), FAILURES_SCHEMA, c.name)
    release_shuffles(store.spark)
    failed = [n for n, st in bad.items() if st == "fail"]
    result.failed_checks += failed
    return {by_name[n].table for n in failed}


def warehouse_build(store: TableStore, ctx: RunContext, calendar: DataFrame | None = None,
                    on_error: str = "stop", workers: int = 4) -> BuildResult:
    """(initial load: date reset + calendar seed) -> staging -> tests ->
    snapshots -> tests -> stats -> facts -> tests, in dependency order.

    ``on_error='stop'`` skips the dependants of a model whose error-severity
    test failed (as a build does); ``'report'`` only records the failures.
    Independent snapshots are submitted concurrently (``workers`` threads), so
    their Spark jobs share the cluster instead of running one after another;
    large ones run alone.
    """
    res = BuildResult()
    entities = [e.name for e in ENTITY_ORDER if store.exists("raw", e.name)]
    if ctx.is_initial_load:
        for e in entities:                                   # K6
            store.publish(reset_dates(store.read("raw", e)), "raw", e)
        if calendar is not None:                             # S7 / N1 seed
            store.publish(calendar, "warehouse", "dim_date")
            res.published.append("dim_date")
    raw = {e: store.read("raw", e) for e in entities}
    stg = stage_all(raw, rows={e: store.rows("raw", e) for e in entities})
    for n, df in stg.items():
        df.createOrReplaceTempView(f"{store.prefix}{n}")
    report = on_error == "report"
    blocked = run_checks(store, STAGING_CHECKS, stg, res)
    if report:
        blocked = set()

    dims: dict[str, DataFrame] = {}
    todo = []
    for name, spec in SNAPSHOTS.items():
        if spec.source not in stg or spec.source in blocked:
            res.skipped.append(name)
        else:
            todo.append((name, spec))

    def merge_one(item):
        name, spec = item
        source, current = stg[spec.source], store.read_snapshot(name, open_only=True)
        known = store.snapshot_open_rows(name)

        def changes(part):
            if current is None:
                return scd2_merge(None, part(source), spec, ctx)
            return scd2_changes(part(current), part(source), spec, ctx, history_rows=known)

        rows = store.rows("raw", STAGING[spec.source].raw_table) or 0
        store.publish_snapshot((changes(p) for p in key_slices(spec.key, rows)), name, ctx.run_id, ctx.run_ts)
        return name

    # independent snapshots run concurrently
    for name in _run_all(merge_one, todo, workers, lambda item: _is_large(store, STAGING[item[1].source].raw_table)):
        res.published.append(name)
        dims[name] = store.read_snapshot(name)
    cal = store.read("warehouse", "dim_date")
    checked = dims if cal is None else {**dims, "dim_date": cal}
    dim_blocked = run_checks(store, [c for c in WAREHOUSE_CHECKS if c.table in checked], checked, res)
    if not report:
        blocked |= dim_blocked

    # Counts of this run's versions (a window of 0 minutes), by the entity's task.  What the run
    # began was counted while it was written, what it closed lies in a partition of its own: no history is read
    lo, hi = S.window_between(ctx.run_ts, minutes=0)
    audit = store.read("raw", AUDIT_TABLE)
    loaded, closed = [], []
    for name, d in dims.items():
        spec = SNAPSHOTS[name]
        task = S.task_name(spec.entity_name())
        begun = store.snapshot_begun(name, ctx.run_id)
        begun = (S.wh_loaded(d, lo, hi).select("value") if begun is None
                 else store.spark.createDataFrame([(begun,)], "value bigint"))
        loaded.append(begun.select(F.lit(task).alias("task_name"), "value"))
        if audit is not None:
            live = audit.filter(F.col("source_name") == spec.entity_name())
            own = store.read_closed(name, ctx.run_id)
            closed.append(S.wh_closed(own, spec.key, live, lo, hi).select(F.lit(task).alias("task_name"), "value"))
    if loaded:
        st = S.update_by_task(_stats(store), reduce(DataFrame.unionByName, loaded), ctx.run_id, "wh_loaded")
        if closed:
            st = S.update_by_task(st, reduce(DataFrame.unionByName, closed), ctx.run_id, "wh_closed")
        store.publish(st, "warehouse", STATS_TABLE)

    facts_ok = {}
    for name, f in FACTS.items():
        needs = {f.source} | {r.dim for r in f.dims}
        if f.source not in stg or any(d not in dims for d in needs - {f.source}) or (needs & blocked):
            res.skipped.append(name)
            continue
        facts_ok[name] = f
    rows = {n: store.rows("warehouse", n) for n in [*dims, "dim_date"]}     # recorded at write time
    # written, checked, and only then made current: a failing fact leaves the old version
    written = {n: store.write(df, "warehouse", n) for n, df in build_facts(stg, dims, cal, list(facts_ok), dim_rows=rows).items()}
    failed: set[str] = set()
    if written:
        tables = {**checked, **{n: w.read(store.spark) for n, w in written.items()}}
        failed = run_checks(store, [c for c in WAREHOUSE_CHECKS if c.table in written], tables, res, rows)
    for name, w in written.items():
        if name in failed and not report:
            res.skipped.append(name)
        else:
            store.commit(w, "warehouse", name)
            res.published.append(name)
    return res


def key_slices(key: str, rows: int, slice_rows: int = SLICE_ROWS, most: int = MAX_SLICES) -> list:
    """Filters that deal the rows of a table by a hash of their key, each row to one slice (null keys as well): a step
    that goes slice by slice shuffles a slice at a time, and the slices together do the same."""
    n = max(1, min(most, -(-rows // slice_rows)))
    if n == 1:
        return [lambda df: df]
    return [lambda df, i=i: df.filter(F.pmod(F.xxhash64(F.col(key)), F.lit(n)) == i) for i in range(n)]


def _is_large(store: TableStore, entity: str) -> bool:
    return (store.rows("raw", entity) or 0) >= LARGE_ROWS


def _run_all(fn, items, workers: int, large=lambda x: False) -> list:
    """Apply ``fn`` to ``items``, ``workers`` at a time; results in input order.
    A ``large`` one runs alone: it keeps the cluster busy by itself, and the
    shuffle files of one are gone before the next makes its own.
    The first error is raised after all submitted work has finished."""
    if workers <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    alone = [bool(large(x)) for x in items]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = [None if a else pool.submit(fn, x) for x, a in zip(items, alone)]
    with ThreadPoolExecutor(max_workers=1) as pool:
        futures = [pool.submit(fn, x) if f is None else f for x, f in zip(items, futures)]
    return [f.result() for f in futures]


def full_run(store: TableStore, landed_root: str, ctx: RunContext, calendar: DataFrame | None = None,
             bronze_root: str | None = None, on_error: str = "stop",
             workers: int = 4, layout: str = "{root}/{entity}", keep_landed: bool = True) -> tuple[list[LoadCounts], BuildResult]:
    """The seven entity loads (independent of each other, so submitted
    concurrently), one run id, their counts recorded once, then the build.
    ``layout`` locates an entity's landed responses under ``landed_root``;
    without ``keep_landed`` they go when every entity is loaded."""
    def load(spec):
        path = layout.format(root=landed_root.rstrip("/"), entity=spec.name)
        return entity_load(store, spec, path, ctx, bronze_root, record=False)
    loads = _run_all(load, list(ENTITY_ORDER), workers, lambda spec: _is_large(store, spec.name))
    record_counts(store, ctx, load_count_rows(loads))
    if not keep_landed:
        drop_path(store.spark, landed_root)
    return loads, warehouse_build(store, ctx, calendar, on_error, workers)
