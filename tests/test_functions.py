import datetime as dt

import duckdb
import pytest

from ledgerlake.functions.scalar import (bool_text, entity_of_table, first_or_null, run_id_expr, run_id_value,
                                         scd_key, text, to_date, to_ts)


@pytest.mark.parametrize("raw,expected", [
    ("2026-07-05T15:36:00Z", 20260705183600),     # summer: UTC+3
    ("2026-01-05T15:36:00Z", 20260105173600),     # winter: UTC+2
    ("20260705183600", 20260705183600),
    (None, 99999999999999),
])
def test_run_id(spark, raw, expected):
    assert run_id_value(raw) == expected
    got = spark.createDataFrame([(raw,)], "r string").select(run_id_expr("r").alias("x")).first()["x"]
    assert got == expected


def test_text_cut_and_bool(spark):
    r = spark.createDataFrame([("abcdefgh", True, None)], "s string, b boolean, n string").select(
        text("s", 3).alias("a"), text("s").alias("full"), bool_text("b").alias("b"), text("n", 2).alias("n")).first()
    assert (r["a"], r["full"], r["b"], r["n"]) == ("abc", "abcdefgh", "true", None)


def test_to_ts_honours_offset(spark):
    r = spark.createDataFrame([("2023-03-01T15:37:00.000Z", "2023-03-01T15:37:00+02:00", "2022-03-21")],
                              "a string, b string, d string").select(
        to_ts("a").alias("a"), to_ts("b").alias("b"), to_date("b").alias("bd"), to_date("d").alias("d")).first()
    assert r["a"] == dt.datetime(2023, 3, 1, 15, 37)
    assert r["b"] == dt.datetime(2023, 3, 1, 13, 37)
    assert r["bd"] == dt.date(2023, 3, 1) and r["d"] == dt.date(2022, 3, 21)


def test_first_or_null_empty_list(spark):
    df = spark.createDataFrame([([],), (["x", "y"],), (None,)], "a array<string>")
    assert [r[0] for r in df.select(first_or_null("a")).collect()] == [None, "x", None]


def test_scd_key_matches_duckdb_md5(spark):
    ts = dt.datetime(1990, 1, 1)
    got = spark.createDataFrame([("a", ts)], "k string, t timestamp_ntz").select(scd_key("k", "t")).first()[0]
    want = duckdb.sql("select md5('a' || '|' || cast(timestamp '1990-01-01 00:00:00' as varchar))").fetchall()[0][0]
    assert got == want


def test_entity_of_table(spark):
    df = spark.createDataFrame([("fact_transaction_audit_log",), ("dim_account",)], "t string")
    assert [r[0] for r in df.select(entity_of_table("t")).collect()] == ["transaction", "account"]
