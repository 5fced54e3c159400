"""Benchmark of the headline operators at one scale factor.

Usage: BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Inputs are materialised once (the stored tables a job would read); each case
then runs one warm-up and three timed runs, reports the median, and forces
the whole result with a ``noop`` write.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.functions.scalar import ts_literal  # noqa: E402
from ledgerlake.operators import quality as Q  # noqa: E402
from ledgerlake.operators.asof import asof_left_join, date_key_join  # noqa: E402
from ledgerlake.operators.calendar import dim_date_covering  # noqa: E402
from ledgerlake.operators.load import sync_deletes, upsert  # noqa: E402
from ledgerlake.operators.scd2 import scd2_changes, scd2_merge  # noqa: E402
from ledgerlake.session import build_session, new_scratch_path  # noqa: E402
from ledgerlake.sources.pages import land_responses, map_pages, read_pages, to_pages  # noqa: E402
from ledgerlake.spec import Check, DimRef, EntitySpec, Prop, RunContext, SnapshotSpec  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SYSTEM_ROW_TIME = "1990-01-01 00:00:00"
RUN2 = "1997-01-01 00:00:00"


def sf_of(path: str) -> float | str:
    tail = os.path.basename(path)
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Store an input as a table of CPUS*2 files, so scans are parallel (the
    driver's test files hold a single row group each, which one task reads)."""
    path = new_scratch_path(df.sparkSession, f"bench-{name}")
    df.repartition(CPUS * 2).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def two_version_dim(spark, src: DataFrame, key: str, attr: str, name: str) -> DataFrame:
    """A snapshot with two versions per key: run 1 (initial load, valid from
    1990), run 2 at RUN2 changing ``attr`` where key % 5 = 0 and deleting
    key % 3 = 0; plus the '-1' system member."""
    k = F.col(key)
    spec = SnapshotSpec(name, "src", "bk", ("bk", "attr"))
    base = src.select(k.cast("string").alias("bk"), F.col(attr).cast("string").alias("attr"),
                      k.alias("_k"), ts_literal(SYSTEM_ROW_TIME).alias("last_edited_time"))
    system = spark.range(1).select(F.lit("-1").alias("bk"), F.lit("-1").alias("attr"),
                                   F.lit(-1).cast(src.schema[key].dataType).alias("_k"),
                                   ts_literal(SYSTEM_ROW_TIME).alias("last_edited_time"))
    s1 = base.unionByName(system)
    h1 = scd2_merge(None, s1.drop("_k"), spec, RunContext(1, SYSTEM_ROW_TIME, True))
    s2 = (s1.filter((F.col("_k") % 3 != 0) | (F.col("bk") == "-1"))
            .withColumn("attr", F.when(F.col("_k") % 5 == 0, F.concat("attr", F.lit(" v2"))).otherwise(F.col("attr")))
            .drop("_k"))
    h1 = materialise(h1, f"{name}-h1")
    return materialise(scd2_merge(h1, s2, spec, RunContext(2, RUN2)), name)


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=CPUS * 2,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    # ---------------------------------------------------------------- setup
    li = table(spark, "lineitem")
    orders = table(spark, "orders")
    dim_part = two_version_dim(spark, table(spark, "part"), "p_partkey", "p_brand", "dim_part")
    dim_supp = two_version_dim(spark, table(spark, "supplier"), "s_suppkey", "s_name", "dim_supp")
    dim_cust = two_version_dim(spark, table(spark, "customer"), "c_custkey", "c_mktsegment", "dim_cust")
    dim_nation = two_version_dim(spark, table(spark, "nation"), "n_nationkey", "n_name", "dim_nation")
    dim_region = two_version_dim(spark, table(spark, "region"), "r_regionkey", "r_name", "dim_region")
    cal = materialise(dim_date_covering(li, "l_shipdate"), "dim_date")
    facts = materialise(
        li.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
          .join(table(spark, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
          .join(table(spark, "nation").select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
          .select(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
                  F.col("l_quantity"), F.col("l_extendedprice").cast("decimal(27,2)").alias("amount"),
                  F.col("l_shipdate").cast("date").alias("ship_date"),
                  F.col("l_partkey").cast("string").alias("part_id"),
                  F.col("l_suppkey").cast("string").alias("supp_id"),
                  F.col("o_custkey").cast("string").alias("cust_id"),
                  F.col("c_nationkey").cast("string").alias("nation_id"),
                  F.col("n_regionkey").cast("string").alias("region_id")), "facts")
    refs = [DimRef("dim_part", "bk", "part_id", "part_dk"), DimRef("dim_supp", "bk", "supp_id", "supp_dk"),
            DimRef("dim_cust", "bk", "cust_id", "cust_dk"), DimRef("dim_nation", "bk", "nation_id", "nation_dk"),
            DimRef("dim_region", "bk", "region_id", "region_dk")]
    dims = {"dim_part": dim_part, "dim_supp": dim_supp, "dim_cust": dim_cust, "dim_nation": dim_nation,
            "dim_region": dim_region}

    ospec = SnapshotSpec("orders_log", "orders", "o_orderkey",
                         ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))
    o_src = orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus", "o_totalprice",
                          "o_orderpriority", F.col("o_orderdate").alias("last_edited_time"))
    o_hist = materialise(scd2_merge(None, o_src, ospec, RunContext(1, SYSTEM_ROW_TIME, True)), "orders_hist")
    n_hist = o_hist.count()
    o_next = o_src.withColumn("o_orderstatus", F.when(F.col("o_orderkey").cast("bigint") % 10 == 0, F.lit("X"))
                              .otherwise(F.col("o_orderstatus")))

    target = materialise(facts.select("id", "l_quantity", "amount", "ship_date"), "raw_target")
    h = F.xxhash64("id")
    batch = materialise(target.filter(F.pmod(h, F.lit(10)) == 0).withColumn("l_quantity", F.col("l_quantity") + 1),
                        "raw_batch")
    live = materialise(target.filter(F.pmod(h, F.lit(20)) != 0).select("id"), "live_ids")
    n_target = target.count()

    ent = EntitySpec("orders", (Prop("Name", "title", "title"), Prop("Status", "status", "select"),
                                Prop("Amount", "amount", "number"), Prop("Date", "date", "date"),
                                Prop("Customer", "customer_id", "relation"), Prop("Urgent", "urgent", "checkbox")))
    docs_src = orders.select(F.col("o_orderkey").cast("string").alias("id"),
                             F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("status"),
                             F.col("o_totalprice").alias("amount"),
                             F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                             F.col("o_custkey").cast("string").alias("customer_id"),
                             (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
                             F.col("o_orderdate").alias("created_time"), F.col("o_orderdate").alias("last_edited_time"))
    landed = new_scratch_path(spark, "bench-landed")
    land_responses(to_pages(docs_src, ent), landed)

    checks = ([Check("pk_fact", "fact", "primary_key", ("id",))]
              + [Check(f"nn_{r.out}", "fact", "not_null", (r.out,)) for r in refs]
              + [Check(f"fk_{r.out}", "fact", "foreign_key", (r.out,), parent=r.dim, parent_columns=("dk",))
                 for r in refs]
              + [Check(f"pk_{n}", n, "primary_key", ("dk",)) for n in dims])

    def fact_build(bc=None):
        df = facts
        for r in refs:
            df = asof_left_join(df, dims[r.dim], r, "ship_date", broadcast=bc)
        return date_key_join(df, cal, "ship_date", "date_dk")

    fact_tbl = materialise(fact_build(), "fact")

    def asof_shuffled():
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            noop(asof_left_join(facts, dim_part, refs[0], "ship_date", broadcast=False))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    def quality():
        Q.summary(checks, {"fact": fact_tbl, **dims}).collect()

    def hard_delete_sync():
        kept, obs = sync_deletes(target, live, target_rows=n_target)   # as the job sizes it
        noop(kept)
        assert obs > 0

    cases = {
        "asof_broadcast": lambda: noop(asof_left_join(facts, dim_part, refs[0], "ship_date", broadcast=True)),
        "asof_sortmerge": asof_shuffled,
        "fact_build_5dims": lambda: noop(fact_build()),
        "scd2_merge_10pct": lambda: noop(scd2_changes(o_hist, o_next, ospec, RunContext(2, RUN2),
                                                      history_rows=n_hist)),
        "upsert_10pct": lambda: noop(upsert(target, batch)),
        "hard_delete_sync": hard_delete_sync,
        "quality_suite": quality,
        "document_flatten": lambda: noop(map_pages(read_pages(spark, landed, ent), ent, RUN2)),
    }
    # the paths a job takes for tables above 5M rows, timed here for their fixed cost
    large_paths = {
        "scd2_merge_10pct_narrow": lambda: noop(scd2_changes(o_hist, o_next, ospec, RunContext(2, RUN2),
                                                             strategy="narrow")),
        "hard_delete_sync_narrow": lambda: noop(sync_deletes(target, live, target_rows=None)[0]),
    }
    only = [c for c in os.environ.get("BENCH_ONLY", "").split(",") if c]

    def median_time(fn):
        fn()                                                   # warm-up
        times = []
        for _ in range(RUNS):
            t = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t)
        return round(statistics.median(times), 3)

    results = {n: median_time(f) for n, f in cases.items() if not only or n in only}
    extra = {n: median_time(f) for n, f in large_paths.items() if not only or n in only}
    total = round(sum(results.values()), 3)
    print(json.dumps({"metric": "sum_of_median_case_seconds", "value": total, "unit": "sec",
                      "queries": results, "sf": sf_of(SF_DIR), "cpus": CPUS,
                      "large_table_paths_not_summed": extra,
                      "rows": {"lineitem": facts.count(), "orders": n_hist}}))


if __name__ == "__main__":
    main()
