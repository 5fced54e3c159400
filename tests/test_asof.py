import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import CapturedException

from ledgerlake.operators.asof import asof_left_join
from ledgerlake.spec import DimRef
from planutil import plan_text

OPEN = dt.datetime(9999, 12, 31)
DIM = "bk string, dk string, scd2_valid_from timestamp_ntz, scd2_valid_to timestamp_ntz"
REF = DimRef("dim", "bk", "key", "out_dk")


def dim(spark, extra=()):
    return spark.createDataFrame([
        ("-1", "unknown", dt.datetime(1990, 1, 1), OPEN),
        ("a", "a1", dt.datetime(1990, 1, 1), dt.datetime(2026, 2, 1)),
        ("a", "a2", dt.datetime(2026, 2, 1), dt.datetime(2026, 3, 1, 10, 30)),
        ("a", "a3", dt.datetime(2026, 3, 1, 10, 30), OPEN),
        *extra], DIM)


FACTS = [
    ("f1", "a", dt.date(2026, 1, 31), "a1"),
    ("f2", "a", dt.date(2026, 2, 1), "a2"),      # exactly on valid_from / previous valid_to
    ("f3", "a", dt.date(1989, 12, 31), "unknown"),   # before every version
    ("f4", "a", dt.date(2026, 3, 1), "a2"),      # the day a version starts after midnight
    ("f5", "a", None, "unknown"),                # null date
    ("f6", None, dt.date(2026, 1, 1), "unknown"),  # null key
    ("f7", "zz", dt.date(2026, 1, 1), "unknown"),  # orphan key
]


@pytest.mark.parametrize("broadcast", [True, False])
def test_boundaries(spark, broadcast):
    facts = spark.createDataFrame([f[:3] for f in FACTS], "fid string, key string, d date")
    if not broadcast:   # above the bound: no broadcast from Spark's own estimate either
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = asof_left_join(facts, dim(spark), REF, "d", broadcast=broadcast)
        got = {r["fid"]: r["out_dk"] for r in out.collect()}
        plan = plan_text(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {f[0]: f[3] for f in FACTS}
    assert ("BroadcastHashJoin" in plan) == broadcast
    if not broadcast:
        assert "SortMergeJoin" in plan


def test_two_system_versions_raise(spark):
    facts = spark.createDataFrame([("f", "zz", dt.date(2026, 1, 1))], "fid string, key string, d date")
    bad = dim(spark, [("-1", "unknown2", dt.datetime(1991, 1, 1), OPEN)])
    with pytest.raises((PySparkException, CapturedException, Exception)) as e:
        asof_left_join(facts, bad, REF, "d", broadcast=True).collect()
    assert "more than one row" in str(e.value).lower() or "SCALAR_SUBQUERY_TOO_MANY_ROWS" in str(e.value)


def _final_plan(df):
    rows = df.collect()           # executes this DataFrame's own plan
    return plan_text(df), rows    # after execution: the final adaptive plan


def test_shuffled_path_salts_null_keys_and_splits_a_hot_key(spark):
    from pyspark.sql import functions as F
    n = 30000
    # a third of the facts on one key, a third with a null key, the rest spread
    facts = spark.range(n).select(
        F.col("id").cast("string").alias("fid"),
        F.when(F.col("id") % 3 == 0, F.lit("a"))
         .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
         .otherwise((F.col("id") % 997).cast("string")).alias("key"),
        F.lit("2026-02-15").cast("date").alias("d")).repartition(8)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = asof_left_join(facts, dim(spark), REF, "d", broadcast=False)
        plan, rows = _final_plan(out)
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "xxhash64" in plan                         # null keys salted, not piled up
    assert "skew=true" in plan                        # AQE split the hot key's partition
    from collections import Counter
    counts = Counter(r["out_dk"] for r in rows)
    assert counts["a2"] == n // 3                     # every hot-key fact matched once
    assert counts["unknown"] == n - n // 3            # null and orphan keys fall back
    assert len(rows) == n                             # no row lost or repeated
