import datetime as dt

from ledgerlake.operators import quality as Q
from ledgerlake.operators import stats as S
from ledgerlake.spec import Check

SCHEMA = "k string, name string, v string"


def test_checks_clean_and_seeded(spark):
    clean = spark.createDataFrame([("1", "a", "true"), ("2", "b", "false")], SCHEMA)
    dirty = spark.createDataFrame([("1", "a", "true"), ("1", None, "maybe"), (None, "c", None)], SCHEMA)
    parent = spark.createDataFrame([("1",), ("2",)], "pk string")
    for df, n_unique, n_null, n_acc, n_pk, n_fk in ((clean, 0, 0, 0, 0, 0), (dirty, 1, 1, 1, 2, 0)):
        assert Q.unique(df, ["k"]).count() == n_unique
        assert Q.not_null(df, "name").count() == n_null
        assert Q.accepted_values(df, "v", ("true", "false")).count() == n_acc
        assert Q.primary_key(df, ["k"]).count() == n_pk
        assert Q.foreign_key(df, "k", parent, "pk").count() == n_fk
    orphan = spark.createDataFrame([("9", "x", "true")], SCHEMA)
    assert Q.foreign_key(orphan, "k", parent, "pk").count() == 1


def test_summary_statuses(spark):
    df = spark.createDataFrame([("1", None, "true")], SCHEMA)
    checks = [Check("nn_name", "t", "not_null", ("name",)),
              Check("nn_k", "t", "not_null", ("k",)),
              Check("warn_expr", "t", "expression", condition="name IS NULL", severity="warn")]
    got = {r["test_name"]: (r["failures"], r["status"]) for r in Q.summary(checks, {"t": df}).collect()}
    assert got == {"nn_name": (1, "fail"), "nn_k": (0, "pass"), "warn_expr": (1, "warn")}
    assert Q.gate(Q.summary(checks, {"t": df})) == ["nn_name"]


def test_stats_insert_then_update(spark):
    st = S.empty_stats(spark)
    upd = lambda n: spark.createDataFrame(
        [(20260705183600, "2026-07-05", "dag", "extract_and_load_account", n)],
        "run_id bigint, run_date string, dag_name string, task_name string, value bigint")
    st = S.upsert_counter(st, upd(5), "ntn_extracted")
    st = S.upsert_counter(st, upd(4), "raw_loaded")
    st = S.upsert_counter(st, upd(6), "ntn_extracted")
    rows = st.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["ntn_extracted"], r["raw_loaded"], r["raw_deleted"], r["run_date"]) == (6, 4, None, dt.date(2026, 7, 5))
    # T4 updates matched rows only, never inserts
    w = spark.createDataFrame([("extract_and_load_account", 3), ("extract_and_load_nope", 9)],
                              "task_name string, value bigint")
    st2 = S.update_by_task(st, w, 20260705183600, "wh_loaded")
    assert [(r["task_name"], r["wh_loaded"]) for r in st2.collect()] == [("extract_and_load_account", 3)]


def test_summary_folds_foreign_keys(spark):
    child = spark.createDataFrame([("1", "x"), ("9", "x"), (None, "q"), ("2", "nope")], "a string, b string")
    pa = spark.createDataFrame([("1",), ("2",), ("2",)], "k string")
    pb = spark.createDataFrame([("x",)], "k string")
    checks = [Check("fk_a", "c", "foreign_key", ("a",), parent="pa", parent_columns=("k",)),
              Check("fk_b", "c", "foreign_key", ("b",), parent="pb", parent_columns=("k",))]
    tables = {"c": child, "pa": pa, "pb": pb}
    got = {r["test_name"]: r["failures"] for r in Q.summary(checks, tables).collect()}
    assert got == {"fk_a": 1, "fk_b": 2}
    assert got == {c.name: Q.failures(c, tables).count() for c in checks}


def test_every_snapshot_counts_for_its_task(spark, tmp_path):
    """The audit logs of transaction and budget set wh_loaded and wh_closed as the dimensions do."""
    from ledgerlake.plans.queries import ctx, q_stats_by_table
    tables = {
        "region": ([(0, "A"), (1, "B")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N", 0), (1, "M", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, f"C{k}", k % 2, 10.0, "AUTO") for k in (1, 2, 5, 34)],
                     "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        # 17 goes, 34 and 51 too, but 51 is planned and was never loaded; 5 and 10 change; 50 changes and is copied as 1000050
        "orders": ([(k, 1, "P" if k == 51 else "O", 5.0, dt.datetime(1995, 3, 1), "1-URGENT") for k in (1, 5, 10, 17, 34, 50, 51)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                   "o_orderpriority string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {(r["run_id"], r["task_name"].removeprefix("extract_and_load_")): (r["wh_loaded"], r["wh_closed"])
           for r in q_stats_by_table(spark, str(tmp_path)).collect()}
    assert all(v == (None, None) for (run, _), v in got.items() if run == ctx(1).run_id)
    now = {e: v for (run, e), v in got.items() if run == ctx(2).run_id}
    assert now["transaction"] == (4, 2)                     # 5, 10, 50 and 1000050 begin; 17 and 34 are gone
    # budget keys are 100 * customer + month: 102, 204 and 510 are gone by k % 17 = 0; k % 5 = 0 changes, and so
    # does what refers to customer 34, a subcategory that is gone and with it the category looked up there
    keys = [100 * k + m for k in (1, 2, 5, 34) for m in range(1, 13)]
    live = [k for k in keys if k % 17]
    assert now["budget"] == (sum(k % 5 == 0 or k // 100 == 34 for k in live), len(keys) - len(live))
    assert now["subcategory"] == (1, 1) and None not in now["account"] + now["year"]
