"""The whole job, three runs (initial load; new, changed, deleted keys;
revived keys), checked against the pure DataFrame composition of the same
steps, plus the run statistics and the test gate."""

import datetime as dt
from collections import Counter

import pytest

from ledgerlake.operators.calendar import dim_date_covering
from ledgerlake.plans import queries as Qs
from ledgerlake.plans.specs import ENTITY_ORDER
from ledgerlake.plans.jobs import STATS_TABLE, full_run
from ledgerlake.session import new_scratch_path
from ledgerlake.sources.pages import land_responses, to_pages
from ledgerlake.sources.testdata import raw_table, read_table


def _bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def _land(spark, sf, run):
    root = new_scratch_path(spark, f"jobtest-landed-{run}")
    for spec in ENTITY_ORDER:
        land_responses(to_pages(raw_table(spark, sf, spec.name, run), spec), f"{root}/{spec.name}")
    return root


@pytest.fixture(scope="module")
def three_runs(spark, sf):
    store = Qs.new_store(spark)
    cal = dim_date_covering(read_table(spark, sf, "orders"), "o_orderdate")
    results = []
    for run, initial in ((1, True), (2, False), (3, False)):
        results.append(full_run(store, _land(spark, sf, run), Qs.ctx(run, initial), cal if initial else None,
                                on_error="report"))
    return store, results


@pytest.mark.parametrize("dim", ["dim_account", "dim_category", "dim_subcategory", "dim_year", "dim_month"])
def test_dimensions_match_composition(spark, sf, three_runs, dim):
    store, _ = three_runs
    assert _bag(store.read_snapshot(dim)) == _bag(Qs.snapshot_runs(spark, sf, dim, Qs.THREE_RUNS))


def test_revived_key_has_a_new_version(spark, three_runs):
    store, _ = three_runs
    d = store.read_snapshot("dim_subcategory")
    # key 17 (k % 17 = 0) was deleted in run 2 and is back in run 3
    versions = d.filter("subcategory_id_bk = '17'").orderBy("scd2_valid_from").collect()
    assert len(versions) == 2
    assert versions[0]["scd2_valid_to"] == dt.datetime(1998, 6, 1)            # closed by run 2
    assert versions[1]["scd2_valid_from"] == dt.datetime(2000, 1, 1, 10, 30)  # back in run 3
    assert versions[1]["scd2_valid_to"] == dt.datetime(9999, 12, 31)


def test_stats_rows(three_runs):
    store, results = three_runs
    stats = {(r["run_id"], r["task_name"]): r for r in store.read("warehouse", STATS_TABLE).collect()}
    assert len(stats) == 3 * 7
    for loads, _ in results:
        for c in loads:
            assert c.extracted == c.loaded
    run2 = Qs.ctx(2).run_id
    sub = stats[(run2, "extract_and_load_subcategory")]
    assert sub["raw_deleted"] > 0 and sub["wh_loaded"] > 0 and sub["wh_closed"] > 0
    # an initial load starts versions at the reset date, outside the run window
    assert stats[(Qs.ctx(1).run_id, "extract_and_load_account")]["wh_loaded"] == 0


def test_gate_stops_dependants(spark, sf):
    store = Qs.new_store(spark)
    cal = dim_date_covering(read_table(spark, sf, "orders"), "o_orderdate")
    _, res = full_run(store, _land(spark, sf, 1), Qs.ctx(1, True), cal, on_error="stop")
    # null transaction dates / amounts fail error-severity staging tests
    assert "not_null_stg_transaction_transaction_date" in res.failed_checks
    assert "fact_transaction" in res.skipped and "fact_transaction_audit_log" in res.skipped
    assert "dim_account" in res.published
    assert store.exists("test_failures", "not_null_stg_transaction_transaction_date")


def test_run_counts_read_no_history(spark):
    """What a run began is counted while it is written, what it closed is read from its own partition."""
    import datetime as dt
    import uuid

    from planutil import plan_text
    from pyspark.sql import functions as F

    from ledgerlake.operators import stats as S
    from ledgerlake.operators.scd2 import scd2_changes, scd2_merge
    from ledgerlake.session import new_scratch_path
    from ledgerlake.sources.store import TableStore
    from ledgerlake.spec import RunContext, SnapshotSpec

    store = TableStore(spark, new_scratch_path(spark, "counts"), prefix=f"c{uuid.uuid4().hex[:8]}_")
    spec = SnapshotSpec("dim_x", "stg_x", "k", ("k", "v"))
    live = spark.createDataFrame([("a",), ("d",)], "id string")
    runs = [[("a", 1), ("b", 1), ("c", 1)], [("a", 2), ("b", 1), ("d", 1)], [("a", 2)]]
    for i, rows in enumerate(runs, 1):
        now = spark.createDataFrame([(k, v, dt.datetime(1990, 1, 1)) for k, v in rows], "k string, v int, last_edited_time timestamp_ntz")
        ctx = RunContext(i, f"2026-0{i}-01 00:00:00")
        current = store.read_snapshot("dim_x", open_only=True)
        changes = scd2_merge(None, now, spec, ctx) if current is None else scd2_changes(current, now, spec, ctx, strategy="wide")
        store.publish_snapshot(changes, "dim_x", i, ctx.run_ts)
        lo, hi = S.window_between(ctx.run_ts, minutes=0)
        whole, closed = store.read_snapshot("dim_x"), store.read_closed("dim_x", i)
        assert store.snapshot_begun("dim_x", i) == S.wh_loaded(whole, lo, hi).first()["value"] == (3, 2, 0)[i - 1]
        assert S.wh_closed(closed, "k", live, lo, hi).first()["value"] == S.wh_closed(whole, "k", live, lo, hi).first()["value"] == (0, 1, 1)[i - 1]
        assert store.snapshot_begun("dim_x", i + 1) is None
        assert f"scd2_segment#" in plan_text(closed).split("PartitionFilters")[1][:80] and closed.agg(F.count("*")).first()[0] == (0, 2, 2)[i - 1]
