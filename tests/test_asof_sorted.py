import datetime as dt
import random

import pytest
from planutil import plan_text
from pyspark.sql import functions as F
from test_asof import FACTS, REF, dim

from ledgerlake.operators import asof
from ledgerlake.operators.asof import asof_left_join, asof_sorted_join

DAY = dt.timedelta(days=1)
START = dt.datetime(2020, 1, 1)


@pytest.mark.parametrize("slice_rows", [1, 2, 1_000_000])
def test_boundaries(spark, slice_rows):
    facts = spark.createDataFrame([f[:3] for f in FACTS], "fid string, key string, d date")
    out = asof_sorted_join(facts, dim(spark), REF, "d", slice_rows=slice_rows)
    assert out.columns == ["fid", "key", "d", "out_dk"]
    assert {r["fid"]: r["out_dk"] for r in out.collect()} == {f[0]: f[3] for f in FACTS}


@pytest.mark.parametrize("slice_rows", [3, 50])
def test_equals_the_join_on_any_history(spark, slice_rows):
    """Gaps, zero-length versions, repeated facts, many facts of one instant, keys without versions."""
    rng = random.Random(slice_rows)
    versions = [("-1", "unknown", dt.datetime(1990, 1, 1), dt.datetime(9999, 12, 31))]
    for k in range(12):
        at = START
        for i in range(rng.choice([0, 1, 5, 60])):
            end = at + rng.choice([0, 1, 1, 2, 9]) * DAY
            versions.append((f"k{k}", f"k{k}v{i}", at, end))
            at = end + rng.choice([0, 0, 1]) * DAY
    facts = [(i, rng.choice([None, "zz", *[f"k{k}" for k in range(12)], "k3", "k3", "k3"]),
              rng.choice([None, START + 5 * DAY, START + 5 * DAY, START + rng.randrange(-3, 200) * DAY + dt.timedelta(hours=rng.choice([0, 13]))]))
             for i in range(900)]
    facts += facts[:20]
    d = spark.createDataFrame(versions, "bk string, dk string, scd2_valid_from timestamp_ntz, scd2_valid_to timestamp_ntz")
    f = spark.createDataFrame(facts, "fid int, key string, d timestamp_ntz")
    key = lambda r: str(tuple(r))
    got = sorted(asof_sorted_join(f, d, REF, "d", slice_rows=slice_rows).collect(), key=key)
    assert got == sorted(asof_left_join(f, d, REF, "d", broadcast=True).collect(), key=key) and len(got) == 920


def test_a_long_history_with_a_third_of_the_facts(spark, monkeypatch):
    """10,000 versions of a key that holds a third of the facts: no product of the two, and no group over the bound."""
    n, versions, bound = 60_000, 10_000, 2_000
    d = spark.range(versions).select(
        F.lit("hot").alias("bk"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("dk"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id"))).alias("scd2_valid_from"),
        F.when(F.col("id") == versions - 1, F.lit(dt.datetime(9999, 12, 31)).cast("timestamp_ntz"))
         .otherwise(F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id") + 1)).alias("scd2_valid_to"))
    d = d.unionByName(dim(spark))
    # a third on the hot key, half of those at one instant, a third with a null key, the rest spread
    hour = F.when(F.col("id") % 6 == 0, 77).otherwise(F.col("id") % 12_000)
    f = spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
        .otherwise((F.col("id") % 997).cast("string")).alias("key"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(hours=hour, mins=F.lit(30))).alias("d"))
    groups = []
    real = asof.Window.partitionBy

    def seen(*cols):
        groups.append(cols)
        return real(*cols)

    monkeypatch.setattr(asof.Window, "partitionBy", seen)
    out = asof_sorted_join(f, d, REF, "d", slice_rows=bound)
    plan = plan_text(out)
    assert groups == [("k", "slice", "part")] and "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    got = {r["id"]: r["out_dk"] for r in out.collect()}
    for i in range(0, n, 37):
        h = 77 if i % 6 == 0 else i % 12_000
        assert got[i] == ("unknown" if i % 3 else f"v{min(h, versions - 1)}")
    assert len(got) == n
    # the hot key's rows, slice by slice
    cuts = asof.time_slices(f.filter("key is not null").select(F.col("key").alias("k"), F.col("d").alias("t")),
                            d.select(F.col("bk").alias("k"), F.col("scd2_valid_from").alias("vf")), bound).collect()
    assert [r["k"] for r in cuts] == ["hot"] and max(cuts[0]["parts"]) > 1 and sum(cuts[0]["parts"]) >= (n // 3 + versions) // bound - 1
    own = f.filter("key = 'hot'").join(F.broadcast(spark.createDataFrame(cuts)))
    sizes = own.select(asof.slice_at(F.col("d")).alias("slice")).groupBy("slice").count().collect()
    parts = {i + 1: p for i, p in enumerate(cuts[0]["parts"])}
    assert max(r["count"] / parts.get(r["slice"], 1) for r in sizes) <= 2 * bound


def test_empty_sides(spark):
    f = spark.createDataFrame([], "fid string, key string, d date")
    assert asof_sorted_join(f, dim(spark), REF, "d").count() == 0
    one = spark.createDataFrame([("f", "a", dt.date(2026, 1, 1))], "fid string, key string, d date")
    assert [r["out_dk"] for r in asof_sorted_join(one, dim(spark).filter("false"), REF, "d").collect()] == [None]
