"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the whole test tables (or data Spark derives from them).  Their DuckDB
counterparts are in ``plans.oracle``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import bool_text, json_path, money, run_id_expr, text, to_date, to_ts
from ledgerlake.operators import quality as Q
from ledgerlake.operators import stats as S
from ledgerlake.operators.asof import asof_left_join, asof_sorted_join, unknown_member
from ledgerlake.operators.calendar import dim_date_covering
from ledgerlake.operators.load import (hard_delete, incremental, reset_dates, skinny, source_filter, sync_deletes, upsert,
                                       watermark, watermark_value)
from ledgerlake.operators.scd2 import scd2_merge
from ledgerlake.operators.stats import empty_stats
from ledgerlake.plans.incremental import changed_keys, fact_load, read_fact
from ledgerlake.plans.specs import (ENTITIES, ENTITY_ORDER, FACTS, PLANNED_STATUS, SNAPSHOTS, STAGING, STAGING_CHECKS,
                                     TRANSACTION, WAREHOUSE_CHECKS)
from ledgerlake.plans.warehouse import build_facts, stage_all, stage_one
from ledgerlake.sources.testdata import RUN_TS, raw_table, read_table
from ledgerlake.plans.jobs import AUDIT_TABLE, FAILURES_SCHEMA, bucketed_entity_load, entity_load, full_run, replace_audit_slice
from ledgerlake.session import drop_path, new_scratch_path, release_shuffles, scratch_dir
from ledgerlake.sources.bronze import read_bronze, replay, write_bronze
from ledgerlake.sources.buckets import BucketedTable
from ledgerlake.sources.pages import land_many, land_responses, map_pages, prop_value, read_pages, to_pages
from ledgerlake.sources.store import TableStore
from ledgerlake.spec import DimRef, EntitySpec, RunContext
from ledgerlake.streaming.history import changes_between, history_of, land, start_history
from ledgerlake.streaming.landing import start_bronze_append, start_ingest

DIM_ENTITIES = ("account", "category", "subcategory", "year", "month")
ENTITY_NAMES = tuple(e.name for e in ENTITY_ORDER)
ALL = frozenset({"drop", "checked", "unchecked", "add"})
NONE = frozenset()


def ctx(run: int, initial: bool = False) -> RunContext:
    return RunContext(run_id=int(RUN_TS[run].replace("-", "").replace(":", "").replace(" ", "")),
                      run_ts=RUN_TS[run], is_initial_load=initial)


def raw_batch(spark, sf, entities, batch: int, reset: bool = False,
              changes=None) -> dict[str, DataFrame]:
    out = {}
    for e in entities:
        df = raw_table(spark, sf, e, batch, changes=changes)
        if e == "transaction":
            df = source_filter(df, TRANSACTION)
        out[e] = reset_dates(df) if reset else df
    return out


def staging_inputs(name: str) -> list[str]:
    spec = STAGING[name]
    return [spec.raw_table] + ([spec.lookup[0]] if spec.lookup else [])


def staged(spark, sf, name: str, batch: int = 1, reset: bool = False, changes=None) -> DataFrame:
    return stage_one(name, raw_batch(spark, sf, staging_inputs(name), batch, reset, changes))


def snapshot_runs(spark, sf, snap: str, runs, strategy: str = "auto") -> DataFrame:
    """History of ``snap`` after ``runs``: a list of (changes, run, initial)."""
    spec = SNAPSHOTS[snap]
    hist = None
    for changes, run, initial in runs:
        stg = staged(spark, sf, spec.source, run, reset=initial, changes=changes)
        hist = scd2_merge(hist, stg, spec, ctx(run, initial), strategy=strategy)
    return hist


THREE_RUNS = [(NONE, 1, True), (ALL, 2, False), (ALL | {"revive"}, 3, False)]
TWO_RUNS = THREE_RUNS[:2]


def dims_after_two_runs(spark, sf, entities=DIM_ENTITIES) -> dict[str, DataFrame]:
    """Initial load (dates reset, updated_at = last_edited_time), then an
    ordinary run on batch 2."""
    return {f"dim_{e}": snapshot_runs(spark, sf, f"dim_{e}", TWO_RUNS) for e in entities}


def _generic_names(df: DataFrame, entity: str) -> DataFrame:
    return df.select(F.lit(entity).alias("entity"),
                     *[F.col(c).alias(c.replace(f"{entity}_", "")) for c in df.columns])


# ------------------------------------------------------------------ staging
def q_stg(name):
    def q(spark, sf):
        return staged(spark, sf, name)
    return q


def q_stg_year_month(spark, sf):
    return _generic_names(staged(spark, sf, "stg_year"), "year").unionByName(
        _generic_names(staged(spark, sf, "stg_month"), "month"))


# --------------------------------------------------------------------- SCD2
SCD2_CASES = {
    "scd2_initial": [(NONE, 1, False)],
    "scd2_new": [(NONE, 1, False), (frozenset({"add"}), 2, False)],
    "scd2_changed": [(NONE, 1, False), (frozenset({"checked"}), 2, False)],
    "scd2_unchecked_frozen": [(NONE, 1, False), (frozenset({"unchecked"}), 2, False)],
    "scd2_hard_delete": [(NONE, 1, False), (frozenset({"drop"}), 2, False)],
    "scd2_revived": [(NONE, 1, False), (frozenset({"drop"}), 2, False), (frozenset({"drop", "revive"}), 3, False)],
    "scd2_two_batches": [(NONE, 1, False), (ALL, 2, False), (ALL | {"revive"}, 3, False)],
    "scd2_initial_load_dates": [(NONE, 1, True), (ALL, 2, False)],
}


def q_scd2_case(case):
    def q(spark, sf):
        return snapshot_runs(spark, sf, "dim_subcategory", SCD2_CASES[case])
    return q


def q_scd2_strategy(strategy):
    """All kinds of change at once, by one of the two merge plans."""
    def q(spark, sf):
        return snapshot_runs(spark, sf, "dim_subcategory", SCD2_CASES["scd2_two_batches"], strategy)
    return q


def q_scd2_spec(snap):
    def q(spark, sf):
        return snapshot_runs(spark, sf, snap, THREE_RUNS)
    return q


def q_scd2_dim_year_month(spark, sf):
    return _generic_names(snapshot_runs(spark, sf, "dim_year", THREE_RUNS), "year").unionByName(
        _generic_names(snapshot_runs(spark, sf, "dim_month", THREE_RUNS), "month"))


# -------------------------------------------------------------------- facts
def fact_transaction_source(spark, sf) -> dict[str, DataFrame]:
    raw = raw_batch(spark, sf, ["subcategory"], 2)
    raw["transaction"] = raw_batch(spark, sf, ["transaction"], 1)["transaction"]
    return stage_all(raw, ["stg_transaction"])


def q_fact_transaction(spark: SparkSession, sf: str) -> DataFrame:
    dims = dims_after_two_runs(spark, sf)
    stg = fact_transaction_source(spark, sf)
    cal = dim_date_covering(stg["stg_transaction"], "transaction_date")
    return build_facts(stg, dims, cal, ["fact_transaction"])["fact_transaction"]


def q_fact_budget(spark, sf):
    dims = dims_after_two_runs(spark, sf, ("category", "subcategory", "year", "month"))
    raw = raw_batch(spark, sf, ["subcategory"], 2)
    raw["budget"] = raw_batch(spark, sf, ["budget"], 1)["budget"]
    stg = stage_all(raw, ["stg_budget"])
    return build_facts(stg, dims, None, ["fact_budget"])["fact_budget"]


def q_asof_single(spark, sf):
    dim = snapshot_runs(spark, sf, "dim_subcategory", TWO_RUNS)
    t = fact_transaction_source(spark, sf)["stg_transaction"]
    ref = DimRef("dim_subcategory", "subcategory_id_bk", "subcategory_id", "subcategory_dk")
    return asof_left_join(t.select("transaction_id_bk", "transaction_date", "subcategory_id"), dim, ref,
                          "transaction_date")


# Fixed: so few rows that keys of the test tables are cut into time slices.
TEST_SLICE_ROWS = 4


def q_asof_sorted(spark, sf):
    dim = snapshot_runs(spark, sf, "dim_subcategory", TWO_RUNS)
    t = fact_transaction_source(spark, sf)["stg_transaction"]
    ref = DimRef("dim_subcategory", "subcategory_id_bk", "subcategory_id", "subcategory_dk")
    return asof_sorted_join(t.select("transaction_id_bk", "transaction_date", "subcategory_id"), dim, ref, "transaction_date",
                            slice_rows=TEST_SLICE_ROWS)


def q_asof_sorted_boundary(spark, sf):
    probes, dim, ref = boundary_probes(spark, sf)
    return asof_sorted_join(probes, dim, ref, "probe_date")


# Fixed probe dates around the fixture's version boundaries.
BOUNDARY_DATES = ("1989-12-31", "1990-01-01", "1998-05-31", "1998-06-01", "1999-12-31", "2000-01-01",
                  "2000-01-02", None)


def boundary_probes(spark, sf) -> tuple[DataFrame, DataFrame, DimRef]:
    dim = snapshot_runs(spark, sf, "dim_subcategory", THREE_RUNS)
    keys = staged(spark, sf, "stg_subcategory", 3, changes=ALL | {"revive"}).select(
        F.col("subcategory_id_bk").alias("subcategory_id"))
    probes = keys.select("subcategory_id", F.explode(F.array(
        *[F.lit(d).cast("date") for d in BOUNDARY_DATES])).alias("probe_date"))
    return probes, dim, DimRef("dim_subcategory", "subcategory_id_bk", "subcategory_id", "subcategory_dk")


def q_asof_boundary(spark, sf):
    probes, dim, ref = boundary_probes(spark, sf)
    return asof_left_join(probes, dim, ref, "probe_date")


def q_unknown_member(spark, sf):
    dims = dims_after_two_runs(spark, sf)
    one = spark.range(1)
    parts = [one.select(F.lit(n).alias("dim"), unknown_member(d, f"{n[4:]}_id_bk").alias("unknown_dk"))
             for n, d in dims.items()]
    return reduce(DataFrame.unionByName, parts)


def q_dim_date(spark, sf):
    return dim_date_covering(read_table(spark, sf, "orders"), "o_orderdate")


# --------------------------------------------------------------------- load
def load_run(spark, sf, entity: str, raw_prev: DataFrame | None, run: int, changes=None,
             source: DataFrame | None = None) -> dict[str, DataFrame]:
    """One entity load on the raw layer: watermark -> incremental read ->
    upsert -> skinny read of the live ids -> hard-delete sync."""
    src = source if source is not None else raw_batch(spark, sf, [entity], run, changes=changes)[entity]
    wm = None if raw_prev is None else watermark_value(raw_prev)
    incr = incremental(src, "last_edited_time", wm)
    target = raw_prev if raw_prev is not None else src.limit(0)      # Spark sees that it is empty
    upserted = upsert(target, incr)
    live = skinny(src, entity)
    kept, removed = hard_delete(upserted, live)
    return {"incr": incr, "upserted": upserted, "live": live, "kept": kept, "removed": removed}


def two_loads(spark, sf, entity: str, changes2=None, source2=None):
    r1 = load_run(spark, sf, entity, None, 1)
    r2 = load_run(spark, sf, entity, r1["kept"], 2, changes2, source2)
    return r1, r2


def q_watermark(spark, sf):
    parts = [watermark(load_run(spark, sf, e, None, 1)["kept"]).select(F.lit(e).alias("entity"), "watermark")
             for e in ENTITY_NAMES]
    return reduce(DataFrame.unionByName, parts)


def q_incremental_filter(spark, sf):
    return two_loads(spark, sf, "subcategory")[1]["incr"]


def q_incremental_full(spark, sf):
    return load_run(spark, sf, "subcategory", None, 2)["incr"]


def q_txn_source_filter(spark, sf):
    return source_filter(raw_table(spark, sf, "transaction", 1), TRANSACTION)


def planned_batch(spark, sf) -> DataFrame:
    """Transactions of batch 1 where k % 11 = 0 turned planned, source-filtered."""
    t = raw_table(spark, sf, "transaction", 2, keep_key=True, changes=NONE)
    t = t.withColumn("status", F.when(F.col("_k") % 11 == 0, F.lit(PLANNED_STATUS)).otherwise(F.col("status")))
    return source_filter(t.drop("_k"), TRANSACTION)


def q_txn_turned_planned(spark, sf):
    return two_loads(spark, sf, "transaction", source2=planned_batch(spark, sf))[1]["removed"]


def q_raw_upsert(spark, sf):
    return two_loads(spark, sf, "subcategory")[1]["upserted"]


def q_raw_upsert_empty(spark, sf):
    return two_loads(spark, sf, "subcategory", changes2=NONE)[1]["upserted"]


def q_sync_deletes(target_rows):
    """What a job keeps, by the plan for small (1) or large (None) targets."""
    def q(spark, sf):
        step = two_loads(spark, sf, "subcategory")[1]
        return sync_deletes(step["upserted"], step["live"], target_rows=target_rows)[0]
    return q


def q_hard_delete_keep(spark, sf):
    return two_loads(spark, sf, "subcategory")[1]["kept"]


def q_hard_delete_removed(spark, sf):
    return two_loads(spark, sf, "subcategory")[1]["removed"]


def q_reset_dates(spark, sf):
    return reset_dates(raw_batch(spark, sf, ["transaction"], 1)["transaction"])


# ------------------------------------------------------------------- scalar
def q_cast_text(spark, sf):
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", text("c_name", 12).alias("name_12"), text("c_mktsegment", 5).alias("segment_5"),
                    text("c_nationkey", 1).alias("nation_1"), text("c_name").alias("name_full"),
                    bool_text(F.col("c_custkey") % 2 == 0).alias("is_even"))


def q_cast_decimal(spark, sf):
    o = read_table(spark, sf, "orders")
    amount = money("o_totalprice")
    return o.select("o_orderkey", amount.alias("amount"), money(amount * 3 - amount).alias("amount_expr"))


OFFSETS = ("Z", "+02:00", "-05:30")


def q_cast_temporal(spark, sf):
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    shifted = F.col("o_orderdate") + F.make_interval(hours=(k % 24).cast("int"))
    off = F.element_at(F.array(*[F.lit(x) for x in OFFSETS]), (k % 3 + 1).cast("int"))
    iso = F.concat(F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss"), off)
    return o.select("o_orderkey", iso.alias("iso_text"), to_ts(iso).alias("as_timestamp"),
                    to_date(iso).alias("as_date"))


def q_run_id_format(spark, sf):
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    shifted = F.col("o_orderdate") + F.make_interval(hours=(k % 24).cast("int"))
    raw = (F.when(k % 11 == 0, F.lit(None).cast("string"))
            .when(k % 3 == 0, (k + 20000000000000).cast("string"))
            .otherwise(F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return o.select("o_orderkey", raw.alias("raw_run_id")).select(
        "o_orderkey", "raw_run_id", run_id_expr("raw_run_id").alias("run_id"))


# ------------------------------------------------------------------ quality
def appended_subcategory_raw(spark, sf) -> DataFrame:
    """Raw subcategory loaded twice without the upsert: duplicate ids."""
    return raw_table(spark, sf, "subcategory", 1).unionByName(raw_table(spark, sf, "subcategory", 2))


def q_dq_unique(spark, sf):
    stg = stage_one("stg_subcategory", {"subcategory": appended_subcategory_raw(spark, sf)})
    return Q.unique(stg, ["subcategory_id_bk"])


def q_dq_unique_composite(spark, sf):
    # the added keys copy the name of an open version: two open versions per name
    return Q.unique(snapshot_runs(spark, sf, "dim_subcategory", SCD2_CASES["scd2_new"]),
                    ["subcategory_name", "scd2_valid_to"])


def _named(df: DataFrame, name: str, cols) -> DataFrame:
    return df.select(F.lit(name).alias("test_name"), *cols)


def q_dq_not_null(spark, sf):
    stg = staged(spark, sf, "stg_transaction")
    checks = [c for c in STAGING_CHECKS if c.kind == "not_null" and c.table == "stg_transaction"]
    return reduce(DataFrame.unionByName, [
        _named(Q.not_null(stg, c.columns[0]), c.name, [F.col("transaction_id_bk").alias("key_value")])
        for c in checks])


def staging_batch2(spark, sf) -> dict[str, DataFrame]:
    return {n: staged(spark, sf, n, 2) for n in STAGING}


def q_dq_accepted_values(spark, sf):
    stg = staging_batch2(spark, sf)
    checks = [c for c in STAGING_CHECKS if c.kind == "accepted_values"]
    return reduce(DataFrame.unionByName, [
        _named(Q.accepted_values(stg[c.table], c.columns[0], c.values), c.name, ["value_field", "n_records"])
        for c in checks])


def q_dq_primary_key(spark, sf):
    raw = {"transaction": raw_batch(spark, sf, ["transaction"], 1)["transaction"],
           "subcategory": appended_subcategory_raw(spark, sf)}
    return Q.primary_key(stage_one("stg_transaction", raw), ["transaction_id_bk"])


def q_dq_foreign_key(spark, sf):
    dims = dims_after_two_runs(spark, sf)
    stg = fact_transaction_source(spark, sf)
    cal = dim_date_covering(stg["stg_transaction"], "transaction_date")
    fact = build_facts(stg, dims, cal, ["fact_transaction"])["fact_transaction"]
    stale = {f"dim_{e}": snapshot_runs(spark, sf, f"dim_{e}", TWO_RUNS[:1]) for e in DIM_ENTITIES}
    stale["dim_date"] = cal
    tables = {"fact_transaction": fact, **stale}
    checks = [c for c in WAREHOUSE_CHECKS if c.kind == "foreign_key" and c.table == "fact_transaction"]
    return reduce(DataFrame.unionByName, [
        _named(Q.failures(c, tables).groupBy(F.col(c.columns[0]).alias("child_value"))
               .agg(F.count(F.lit(1)).alias("n_records")), c.name, ["child_value", "n_records"])
        for c in checks])


def q_dq_singular_warn(spark, sf):
    dims = dims_after_two_runs(spark, sf)
    stg = fact_transaction_source(spark, sf)
    cal = dim_date_covering(stg["stg_transaction"], "transaction_date")
    fact = build_facts(stg, dims, cal, ["fact_transaction"])["fact_transaction"]
    chk = next(c for c in WAREHOUSE_CHECKS if c.name == "transaction_amount_is_null")
    return Q.expression(fact, chk.condition)


def q_dq_summary(spark, sf):
    return Q.summary(STAGING_CHECKS, staging_batch2(spark, sf))


# -------------------------------------------------------------------- stats
def load_counts(spark, sf) -> DataFrame:
    """(run, entity, extracted, deleted) of both loads of all seven entities:
    an aggregate over tagged rows for each entity, checkpointed (a small table)
    so the stats updates below do not re-plan the load chains."""
    def of_entity(e):
        r1, r2 = two_loads(spark, sf, e)
        tagged = reduce(DataFrame.unionByName, [r[part].select(F.lit(run).alias("run"), F.lit(e).alias("entity"), F.lit(part).alias("tag"))
                                                for run, r in ((1, r1), (2, r2)) for part in ("incr", "removed")])
        return tagged.groupBy("run", "entity").agg(F.count_if(F.col("tag") == "incr").alias("extracted"),
                                                   F.count_if(F.col("tag") == "removed").alias("deleted"))
    return one_by_one(spark, of_entity, ENTITY_NAMES)


def one_by_one(spark, aggregate, names) -> DataFrame:
    """The few rows of each name's aggregate, each worked out and kept before the next is planned: the driver holds
    one name's plan and broadcast sides at a time, not those of all."""
    scratch_dir(spark)
    return reduce(DataFrame.unionByName, [aggregate(n).checkpoint(eager=True) for n in names])


def loads_with_stats(spark, sf):
    """sys_etl_stats after two runs of all seven entity loads."""
    stats = empty_stats(spark)
    counts = load_counts(spark, sf)
    for run in (1, 2):
        c = ctx(run)
        per_run = counts.filter(F.col("run") == run).select(
            F.lit(c.run_id).cast("bigint").alias("run_id"), F.lit(RUN_TS[run][:10]).cast("date").alias("run_date"),
            F.lit(c.dag_name).alias("dag_name"), F.concat(F.lit("extract_and_load_"), "entity").alias("task_name"),
            "extracted", "deleted")
        for column, src in (("ntn_extracted", "extracted"), ("raw_loaded", "extracted"), ("raw_deleted", "deleted")):
            stats = S.upsert_counter(stats, per_run.withColumn("value", F.col(src)), column)
    return stats, counts


def q_stats_upsert(spark, sf):
    return loads_with_stats(spark, sf)[0]


def q_run_stats(spark, sf):
    """Counts of the second run per entity, from a union of its tagged rows."""
    def of_entity(e):
        _, r2 = two_loads(spark, sf, e)
        tagged = reduce(DataFrame.unionByName, [r2[part].select(F.lit(e).alias("entity"), F.lit(tag).alias("tag"))
                                                for part, tag in (("incr", "loaded"), ("removed", "deleted"), ("live", "live"))])
        return tagged.groupBy("entity").agg(
            F.count_if(F.col("tag") == "loaded").alias("ntn_extracted"),
            F.count_if(F.col("tag") == "loaded").alias("raw_loaded"),
            F.count_if(F.col("tag") == "deleted").alias("raw_deleted"))
    return one_by_one(spark, of_entity, ENTITY_NAMES)


def _wh_count(spark, sf, kind: str, snap: str) -> DataFrame:
    spec = SNAPSHOTS[snap]
    e = spec.entity_name()
    d = snapshot_runs(spark, sf, snap, TWO_RUNS)
    lo, hi = S.window_between(RUN_TS[2])
    if kind == "loaded":
        v = S.wh_loaded(d, lo, hi)
    else:
        live = skinny(raw_batch(spark, sf, [e], 2)[e], e)
        v = S.wh_closed(d, spec.key, live, lo, hi)
    return v.select(F.lit(snap).alias("table_name"), F.lit(S.task_name(e)).alias("task_name"), F.col("value"))


def _wh_counts(spark, sf, kind: str):
    """Counts of the dimensions (the audit logs are counted in ``stats_by_table``)."""
    return reduce(DataFrame.unionByName, [_wh_count(spark, sf, kind, f"dim_{e}") for e in DIM_ENTITIES])


def q_stats_wh_loaded(spark, sf):
    return _wh_counts(spark, sf, "loaded").withColumnRenamed("value", "wh_loaded")


def q_stats_wh_closed(spark, sf):
    return _wh_counts(spark, sf, "closed").withColumnRenamed("value", "wh_closed")


def q_stats_by_table(spark, sf):
    """Every snapshot counts for its entity's task, the audit logs as well as the dimensions."""
    stats, _ = loads_with_stats(spark, sf)
    rid = ctx(2).run_id
    for kind in ("loaded", "closed"):
        counts = one_by_one(spark, lambda n: _wh_count(spark, sf, kind, n), SNAPSHOTS)
        stats = S.update_by_task(stats, counts, rid, f"wh_{kind}")
    return stats


# ---------------------------------------------------------------- documents
def landed(spark, sf, entity: str, batch: int = 1, changes=None) -> str:
    """Land the source state of ``entity`` as API response files."""
    raw = raw_table(spark, sf, entity, batch, changes=changes)
    path = new_scratch_path(spark, f"landed-{entity}-b{batch}")
    land_responses(to_pages(raw, ENTITIES[entity]), path)
    return path


def q_page_explode(spark, sf):
    pages = read_pages(spark, landed(spark, sf, "transaction"), TRANSACTION)
    return pages.select("id", "created_time", "last_edited_time", "archived")


def q_page_pruned(spark, sf):
    pages = read_pages(spark, landed(spark, sf, "transaction"), TRANSACTION, only=["Name"])
    return pages.select("id", prop_value(TRANSACTION.props[0]).alias("title"))


def mapped(spark, sf, entity: str, batch: int = 1) -> DataFrame:
    spec = ENTITIES[entity]
    pages = read_pages(spark, landed(spark, sf, entity, batch), spec)
    return source_filter(map_pages(pages, spec, RUN_TS[batch]), spec)


def q_map(entity):
    def q(spark, sf):
        return mapped(spark, sf, entity)
    return q


def q_map_year_month(spark, sf):
    return (mapped(spark, sf, "year").select(F.lit("year").alias("entity"), "*")
            .unionByName(mapped(spark, sf, "month").select(F.lit("month").alias("entity"), "*")))


def q_ids_audit(spark, sf):
    store = TableStore(spark, new_scratch_path(spark, "store"), prefix=f"t{uuid.uuid4().hex[:8]}_")
    # a later run replaces one entity's slice only
    for spec, run in [*((e, 1) for e in ENTITY_ORDER), (ENTITIES["subcategory"], 2)]:
        path = landed(spark, sf, spec.name, run)
        replace_audit_slice(store, spec.name, live_ids(spark, path, spec))
        drop_path(spark, path)                  # the slice is written: its responses are not read again
        release_shuffles(spark)
    return store.read("raw", AUDIT_TABLE).select("id", "title", "source_name")


def live_ids(spark, path: str, spec: EntitySpec) -> DataFrame:
    """Skinny read of all live pages: title plus the properties the source
    filter needs (S4, P9)."""
    need = {spec.title_prop} | {p.name for p in spec.props if p.column in {c for c, _ in spec.exclude_equal}}
    pages = read_pages(spark, path, spec, only=sorted(need))
    cols = [prop_value(p).alias(p.column) for p in spec.props if p.name in need]
    return source_filter(pages.select("id", *cols), spec).select("id", "title")


def q_json_path(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", json_path("props", "$.k").alias("k"))


# ------------------------------------------------------------------- bronze
def q_bronze_roundtrip(spark, sf):
    raw = raw_batch(spark, sf, ["transaction"], 1)["transaction"]
    root = new_scratch_path(spark, "bronze")
    write_bronze(raw, root, "transaction", ctx(1).run_id)
    return read_bronze(spark, root, "transaction", raw.schema).drop("run_id")


def q_bronze_replay(spark, sf):
    r1, r2 = two_loads(spark, sf, "subcategory")
    root = new_scratch_path(spark, "bronze")
    write_bronze(r1["incr"], root, "subcategory", ctx(1).run_id)
    write_bronze(r2["incr"], root, "subcategory", ctx(2).run_id)
    schema = r1["incr"].schema
    hist = read_bronze(spark, root, "subcategory", schema)
    return replay(hist).select(*schema.names)


# --------------------------------------------------------------------- jobs
def new_store(spark) -> TableStore:
    return TableStore(spark, new_scratch_path(spark, "store"), prefix=f"t{uuid.uuid4().hex[:8]}_")


def q_entity_load(spark, sf):
    store = new_store(spark)
    spec = ENTITIES["subcategory"]
    for run in (1, 2):
        entity_load(store, spec, landed(spark, sf, "subcategory", run), ctx(run))
    return store.read("raw", "subcategory")


# Fixed: few enough for the test tables; a job takes them from the table's size.
TEST_BUCKETS = 8


def two_bucketed_loads(spark, sf, with_deletes: bool) -> DataFrame:
    """Both loads of the subcategory into a raw table kept in key buckets."""
    table = BucketedTable(new_store(spark), "raw", "subcategory", buckets=TEST_BUCKETS)
    for run in (1, 2):
        src = raw_batch(spark, sf, ["subcategory"], run)["subcategory"]
        live = skinny(src, "subcategory")
        # the first load deletes what is not live in any case, as the plain load does
        table.load(incremental(src, "last_edited_time", table.watermark()), live if with_deletes or run == 1 else None)
    return table.read()


def q_upsert_bucketed(spark, sf):
    return two_bucketed_loads(spark, sf, False)


def q_delete_sync_bucketed(spark, sf):
    return two_bucketed_loads(spark, sf, True)


def q_entity_load_bucketed(spark, sf):
    store = new_store(spark)
    spec = ENTITIES["subcategory"]
    for run in (1, 2):
        bucketed_entity_load(store, spec, landed(spark, sf, "subcategory", run), ctx(run), TEST_BUCKETS)
    return store.read("raw", "subcategory")


def fact_after_feeds(spark, sf, name: str, entity: str, dim_entities) -> DataFrame:
    """The fact built after the initial run, then brought up to the second run from the dimensions' feeds."""
    store, spec = new_store(spark), FACTS[name]
    for run in (1, 2):
        raw = raw_batch(spark, sf, ["subcategory"], run)
        raw[entity] = raw_batch(spark, sf, [entity], 1)[entity]
        stg = stage_all(raw, [spec.source])
        dims = {f"dim_{e}": snapshot_runs(spark, sf, f"dim_{e}", TWO_RUNS[:run]) for e in dim_entities}
        feeds = {} if run == 1 else {r.dim: changed_keys(dims[r.dim], r.dim_key, RUN_TS[run]) for r in spec.dims}
        cal = dim_date_covering(stg[spec.source], spec.as_of) if spec.date_dim_out else None
        fact_load(store, spec, stg[spec.source], dims, feeds, ctx(run), cal, TEST_BUCKETS)
    return read_fact(store, spec)


def q_fact_transaction_feed(spark, sf):
    return fact_after_feeds(spark, sf, "fact_transaction", "transaction", DIM_ENTITIES)


def q_fact_budget_feed(spark, sf):
    return fact_after_feeds(spark, sf, "fact_budget", "budget", ("category", "subcategory", "year", "month"))


def two_full_runs(spark, sf, on_error: str = "report") -> TableStore:
    """The whole job twice: an initial load of batch 1, then batch 2."""
    store = new_store(spark)
    cal = dim_date_covering(read_table(spark, sf, "orders"), "o_orderdate")
    for run, initial in ((1, True), (2, False)):
        root = new_scratch_path(spark, f"landed-run{run}")
        land_many({spec.name: to_pages(raw_table(spark, sf, spec.name, run), spec) for spec in ENTITY_ORDER}, root)
        full_run(store, root, ctx(run, initial), cal if initial else None, on_error=on_error,
                 layout="{root}/entity={entity}", keep_landed=False)
    return store


def q_warehouse_build(spark, sf):
    return two_full_runs(spark, sf).read("warehouse", "fact_transaction")


def q_dq_failures(spark, sf):
    store = two_full_runs(spark, sf)
    parts = [store.read(FAILURES_SCHEMA, c.name).agg(F.count(F.lit(1)).alias("stored_rows"))
             .select(F.lit(c.name).alias("test_name"), "stored_rows")
             for c in STAGING_CHECKS if store.exists(FAILURES_SCHEMA, c.name)]
    return reduce(DataFrame.unionByName, parts).filter("stored_rows > 0")


# ---------------------------------------------------------------- streaming
def q_stream_landing_upsert(spark, sf):
    store = new_store(spark)
    spec = ENTITIES["subcategory"]
    land = new_scratch_path(spark, "stream-landing")
    chk = new_scratch_path(spark, "stream-checkpoint")
    for run in (1, 2):
        land_responses(to_pages(raw_table(spark, sf, "subcategory", run), spec), f"{land}/run={run}")
        q = start_ingest(store, spec, f"{land}/run=*", chk, RUN_TS[2], trigger_once=True)
        q.awaitTermination()
    return store.read("raw", "subcategory").drop("load_date")


def q_stream_bronze_append(spark, sf):
    """Stream both batches' landed pages into bronze, then replay bronze."""
    spec = ENTITIES["subcategory"]
    land = new_scratch_path(spark, "stream-landing")
    bronze = new_scratch_path(spark, "stream-bronze")
    chk = new_scratch_path(spark, "stream-checkpoint")
    for run in (1, 2):
        land_responses(to_pages(raw_table(spark, sf, "subcategory", run), spec), f"{land}/run={run}")
        start_bronze_append(spark, spec, f"{land}/run=*", f"{bronze}/subcategory", chk,
                            trigger_once=True).awaitTermination()
    schema = mapped_schema(spec)
    return replay(read_bronze(spark, bronze, "subcategory", schema)).drop("load_date")


def q_scd2_stream(spark, sf):
    """The three source states landed, then read by one stream; the versions it tells of."""
    spec = SNAPSHOTS["dim_subcategory"]
    land_at, out, chk = (new_scratch_path(spark, f"history-{x}") for x in ("landing", "events", "checkpoint"))
    before = None
    for changes, run, _ in SCD2_CASES["scd2_two_batches"]:
        now = staged(spark, sf, spec.source, run, changes=changes)
        landed_rows = changes_between(before, now, spec.key, RUN_TS[run])
        land(landed_rows, land_at, ctx(run).run_id)
        before = now
    start_history(spark, land_at, landed_rows.schema, spec, out, chk).awaitTermination()
    return history_of(spark.read.parquet(out), spec)


def mapped_schema(spec: EntitySpec):
    empty = spark_empty_pages(spec)
    return map_pages(empty, spec, "1970-01-01 00:00:00").schema


def spark_empty_pages(spec: EntitySpec):
    from pyspark.sql import SparkSession
    from ledgerlake.sources.pages import page_schema
    return SparkSession.getActiveSession().createDataFrame([], page_schema(spec.props))


QUERIES = {
    **{n: q_stg(n) for n in ("stg_account", "stg_category", "stg_subcategory", "stg_transaction", "stg_budget")},
    "stg_year_month": q_stg_year_month,
    **{n: q_scd2_case(n) for n in SCD2_CASES},
    **{f"scd2_changes_{s}": q_scd2_strategy(s) for s in ("wide", "narrow")},
    **{f"scd2_{n}": q_scd2_spec(n) for n in ("dim_account", "dim_category", "dim_subcategory")},
    "scd2_dim_year_month": q_scd2_dim_year_month,
    "scd2_transaction_log": q_scd2_spec("fact_transaction_audit_log"),
    "scd2_budget_log": q_scd2_spec("fact_budget_audit_log"),
    "asof_single": q_asof_single,
    "asof_boundary": q_asof_boundary,
    "asof_sorted": q_asof_sorted,
    "asof_sorted_boundary": q_asof_sorted_boundary,
    "unknown_member": q_unknown_member,
    "fact_transaction": q_fact_transaction,
    "fact_budget": q_fact_budget,
    "fact_transaction_feed": q_fact_transaction_feed,
    "fact_budget_feed": q_fact_budget_feed,
    "dim_date": q_dim_date,
    "watermark": q_watermark,
    "incremental_filter": q_incremental_filter,
    "incremental_full": q_incremental_full,
    "txn_source_filter": q_txn_source_filter,
    "txn_turned_planned": q_txn_turned_planned,
    "raw_upsert": q_raw_upsert,
    "raw_upsert_empty": q_raw_upsert_empty,
    "hard_delete_keep": q_hard_delete_keep,
    "sync_deletes_small": q_sync_deletes(1),
    "sync_deletes_large": q_sync_deletes(None),
    "hard_delete_removed": q_hard_delete_removed,
    "reset_dates": q_reset_dates,
    "cast_text": q_cast_text,
    "cast_decimal": q_cast_decimal,
    "cast_temporal": q_cast_temporal,
    "run_id_format": q_run_id_format,
    "dq_unique": q_dq_unique,
    "dq_unique_composite": q_dq_unique_composite,
    "dq_not_null": q_dq_not_null,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_primary_key": q_dq_primary_key,
    "dq_foreign_key": q_dq_foreign_key,
    "dq_singular_warn": q_dq_singular_warn,
    "dq_summary": q_dq_summary,
    "stats_upsert": q_stats_upsert,
    "run_stats": q_run_stats,
    "stats_wh_loaded": q_stats_wh_loaded,
    "stats_wh_closed": q_stats_wh_closed,
    "stats_by_table": q_stats_by_table,
    "page_explode": q_page_explode,
    "page_pruned": q_page_pruned,
    **{f"map_{e}": q_map(e) for e in ("account", "category", "subcategory", "budget", "transaction")},
    "map_year_month": q_map_year_month,
    "ids_audit": q_ids_audit,
    "json_path": q_json_path,
    "bronze_roundtrip": q_bronze_roundtrip,
    "bronze_replay": q_bronze_replay,
    "entity_load": q_entity_load,
    "upsert_bucketed": q_upsert_bucketed,
    "delete_sync_bucketed": q_delete_sync_bucketed,
    "entity_load_bucketed": q_entity_load_bucketed,
    "warehouse_build": q_warehouse_build,
    "dq_failures": q_dq_failures,
    "stream_landing_upsert": q_stream_landing_upsert,
    "stream_bronze_append": q_stream_bronze_append,
    "scd2_stream": q_scd2_stream,
}
