import datetime as dt

from ledgerlake.operators.load import (hard_delete, incremental, replace_slice, reset_dates, source_filter, upsert,
                                       watermark_value)
from ledgerlake.plans.specs import TRANSACTION
from ledgerlake.sources.testdata import budget_base
from planutil import plan_text
from pyspark.sql import functions as F

SCHEMA = "id string, title string, load_date timestamp_ntz"
T1, T2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)


def test_upsert_replaces_and_appends(spark):
    target = spark.createDataFrame([("a", "old", T1), ("b", "keep", T1)], SCHEMA)
    batch = spark.createDataFrame([("a", "new", T2), ("c", "n1", T2), ("c", "n2", T2)], SCHEMA)
    out = sorted(tuple(r) for r in upsert(target, batch).collect())
    # duplicate ids inside the batch are all kept
    assert out == [("a", "new", T2), ("b", "keep", T1), ("c", "n1", T2), ("c", "n2", T2)]


def test_upsert_empty_batch_leaves_target(spark):
    target = spark.createDataFrame([("a", "old", T1)], SCHEMA)
    assert [tuple(r) for r in upsert(target, spark.createDataFrame([], SCHEMA)).collect()] == [("a", "old", T1)]


def test_hard_delete(spark):
    target = spark.createDataFrame([("a", "x", T1), ("b", "y", T1), (None, "z", T1)], SCHEMA)
    live = spark.createDataFrame([("a",), (None,)], "id string")
    kept, removed = hard_delete(target, live)
    assert [r["id"] for r in kept.collect()] == ["a"]
    assert sorted((r["id"] or "") for r in removed.collect()) == ["", "b"]   # a null id is removed
    kept, removed = hard_delete(target, spark.createDataFrame([], "id string"))
    assert kept.count() == 0 and removed.count() == 3                          # empty live set


def test_watermark_and_incremental(spark):
    t = spark.createDataFrame([("a", "x", T1), ("b", "y", T2)], SCHEMA)
    assert watermark_value(t) == T2
    assert watermark_value(t.filter("false")) is None
    src = spark.createDataFrame([("a", T1), ("b", T2)], "id string, last_edited_time timestamp_ntz")
    assert incremental(src, "last_edited_time", None).count() == 2
    assert [r["id"] for r in incremental(src, "last_edited_time", T1).collect()] == ["b"]   # strictly after


def test_source_filter_is_null_safe(spark):
    df = spark.createDataFrame([("1", False, "Платено"), ("2", True, "Платено"), ("3", False, "Предстои"),
                                ("4", None, None)], "id string, is_template boolean, status string")
    assert sorted(r["id"] for r in source_filter(df, TRANSACTION).collect()) == ["1", "4"]


def test_reset_dates_and_slice(spark):
    df = spark.createDataFrame([("a", T1, T2)], "id string, created_time timestamp_ntz, last_edited_time timestamp_ntz")
    r = reset_dates(df).first()
    assert r["created_time"] == r["last_edited_time"] == dt.datetime(1990, 1, 1)
    audit = spark.createDataFrame([("a", "t", "account"), ("b", "t", "category")], "id string, title string, source_name string")
    new = replace_slice(audit, spark.createDataFrame([], "id string, title string, source_name string"), "account")
    assert [r["id"] for r in new.collect()] == ["b"]


import pytest  # noqa: E402


@pytest.mark.parametrize("target_rows", [None, 3])        # narrow-first, single pass
def test_sync_deletes(spark, target_rows):
    from ledgerlake.operators.load import sync_deletes
    target = spark.createDataFrame([("a", "x", T1), ("a", "x2", T1), ("b", "y", T1), (None, "z", T1)], SCHEMA)
    kept, obs = sync_deletes(target, spark.createDataFrame([("a",), ("c",), (None,)], "id string"),
                             target_rows=target_rows)
    assert sorted(r["title"] for r in kept.collect()) == ["x", "x2"]
    assert obs == 2


def test_latest_per_key(spark):
    from ledgerlake.operators.load import latest_per_key
    df = spark.createDataFrame([("a", "x", T1), ("a", "y", T2), ("a", "y2", T2), ("b", "z", T1), ("b", "z", T1),
                                (None, "n", T1)], SCHEMA.replace("load_date", "t"))
    got = sorted((r["id"] or "", r["title"]) for r in latest_per_key(df, "id", ["t"]).collect())
    assert got == [("", "n"), ("a", "y"), ("a", "y2"), ("b", "z"), ("b", "z")]        # ties kept
    one = sorted((r["id"] or "", r["title"]) for r in latest_per_key(df, "id", ["t"], one_per_key=True).collect())
    assert one == [("", "n"), ("a", "y2"), ("b", "z")]


def test_many_ids_are_not_broadcast(spark, tmp_path):
    """Spark takes the size of a side from its file: the ids that an explode makes of a few rows are no small side."""
    few = str(tmp_path / "few")
    spark.range(3).selectExpr("id AS n").write.parquet(few)
    many = spark.read.parquet(few).selectExpr("explode(sequence(1, 1000)) AS k", "n").selectExpr("concat(n, '-', k) AS id")
    target = spark.range(5000).selectExpr("concat(id % 4, '-', id) AS id")
    want = target.join(many, "id", "left_semi").count()
    kept, removed = hard_delete(target, many)
    assert "Broadcast" not in plan_text(kept) + plan_text(removed)
    assert kept.count() == want and removed.count() == 5000 - want and 0 < want < 5000
    spark.conf.set("ledgerlake.broadcast.maxRows", "2999")
    try:
        out = upsert(target, many)
        assert "Broadcast" not in plan_text(out) and out.count() == 5000 - want + 3000
        spark.conf.set("ledgerlake.broadcast.maxRows", "3000")
        assert "BroadcastHashJoin" in plan_text(upsert(target, many))
    finally:
        spark.conf.unset("ledgerlake.broadcast.maxRows")


def test_budgets_of_a_small_file_are_made_by_many_tasks(spark, tmp_path):
    rows = spark.range(120_000).selectExpr("nullif(id % 70000, 7) AS c_custkey", "concat('c', id) AS c_name", "id / 4D AS c_acctbal")
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    made = budget_base(spark, str(tmp_path))
    per_task = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 12 * 120_000 and len(per_task) >= 3 and max(per_task) < 12 * 60_000
