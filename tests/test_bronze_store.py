import datetime as dt

from ledgerlake.session import new_scratch_path
from ledgerlake.sources.bronze import read_bronze, replay, write_bronze
from ledgerlake.sources.store import TableStore

SCHEMA = "id string, note string, amount double, t timestamp_ntz"


def test_bronze_roundtrip_skip_empty_and_replay(spark):
    root = new_scratch_path(spark, "bronze-test")
    df1 = spark.createDataFrame([("a", 'say "hi",\nthen go', 1.5, dt.datetime(2026, 1, 1, 1, 2, 3)),
                                 ("b", None, None, None)], SCHEMA)
    assert write_bronze(df1, root, "e", 1)
    assert not write_bronze(df1.filter("false"), root, "e", 2)      # nothing written
    df2 = spark.createDataFrame([("a", "v2", 2.0, dt.datetime(2026, 2, 1))], SCHEMA)
    write_bronze(df2, root, "e", 3)
    write_bronze(df2, root, "e", 3)                                   # a rerun replaces its run
    hist = read_bronze(spark, root, "e", df1.schema)
    assert hist.count() == 3
    back = {r["id"]: r for r in hist.filter("run_id = 1").collect()}
    assert back["a"]["note"] == 'say "hi",\nthen go' and back["a"]["t"] == dt.datetime(2026, 1, 1, 1, 2, 3)
    latest = {r["id"]: r["note"] for r in replay(hist).collect()}
    assert latest == {"a": "v2", "b": None}


def test_store_versions(spark):
    store = TableStore(spark, new_scratch_path(spark, "store-test"), prefix="ut_")
    df = spark.createDataFrame([("a",)], "id string")
    assert store.publish(df, "raw", "x") == 1
    # publish a version computed from the current one (no self-overwrite)
    assert store.publish(store.read("raw", "x").unionByName(spark.createDataFrame([("b",)], "id string")),
                         "raw", "x") == 2
    assert sorted(r["id"] for r in store.read("raw", "x").collect()) == ["a", "b"]
    assert store.version("raw", "x") == 2


def test_bronze_table_by_sql(spark):
    from ledgerlake.sources.bronze import register_bronze
    root = new_scratch_path(spark, "bronze-sql")
    df = spark.createDataFrame([("a", "x", 1.0, dt.datetime(2026, 1, 1))], SCHEMA)
    write_bronze(df, root, "e", 7)
    write_bronze(df, root, "e", 8)
    register_bronze(spark, root, "e", df.schema, "bronze_e_test")
    r = spark.sql("SELECT run_id, count(*) AS n FROM bronze_e_test GROUP BY run_id ORDER BY run_id").collect()
    assert [(x["run_id"], x["n"]) for x in r] == [(7, 1), (8, 1)]


def test_typed_seed(spark):
    from ledgerlake.sources.seeds import read_seed
    path = new_scratch_path(spark, "seed")
    spark.createDataFrame([("20260101", "2026-01-01", "Thursday-long", "01")],
                          "dk string, date string, `day_of_week` string, `calendar_year-month` string") \
        .coalesce(1).write.option("header", "true").csv(path)
    r = read_seed(spark, path, {"dk": "varchar(10)", "date": "date", "day_of_week": "varchar(9)",
                                "calendar_year-month": "numeric(2)"}).first()
    assert (r["dk"], r["date"], r["day_of_week"], r["calendar_year-month"]) == \
        ("20260101", dt.date(2026, 1, 1), "Thursday-", 1)


def test_store_records_row_counts(spark):
    store = TableStore(spark, new_scratch_path(spark, "store-rows"), prefix="rows_")
    store.publish(spark.range(7).selectExpr("cast(id as string) AS id"), "raw", "x")
    assert store.rows("raw", "x") == 7
    assert store.rows("raw", "missing") is None


def test_store_records_watermark(spark):
    store = TableStore(spark, new_scratch_path(spark, "store-wm"), prefix="wm_")
    df = spark.createDataFrame([("a", dt.datetime(2026, 1, 1)), ("b", dt.datetime(2026, 2, 1, 3, 4, 5))],
                               "id string, load_date timestamp_ntz")
    store.publish(df, "raw", "x")
    assert store.watermark("raw", "x") == (True, "2026-02-01 03:04:05")
    store.publish(df.filter("false"), "raw", "x")
    assert store.watermark("raw", "x") == (True, None)
    assert store.watermark("raw", "missing") == (True, None)
