import datetime as dt
import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.facts import build_fact
from ledgerlake.operators.scd2 import scd2_changes, scd2_merge
from ledgerlake.plans import incremental as I
from ledgerlake.session import new_scratch_path
from ledgerlake.sources.buckets import BucketedTable
from ledgerlake.sources.store import TableStore
from ledgerlake.spec import DimRef, FactSpec, RunContext, SnapshotSpec

DIM = SnapshotSpec("dim_thing", "stg_thing", "thing_bk", ("thing_bk", "name"))
SPEC = FactSpec("fact_sale", "stg_sale", ("sale_bk", "amount", "sold"), as_of="sold",
                dims=(DimRef("dim_thing", "thing_bk", "thing", "thing_dk"),), key=("sale_bk",))
RUNS = ["2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00"]
BUCKETS = 16


def things(spark, run):
    """Run 2 renames t3 and drops t5; run 3 brings t5 back and adds t99."""
    rows = [(f"t{i}", f"name {i}") for i in range(20)] + [("-1", "unknown")]
    if run >= 2:
        rows = [(k, n + " *" if k == "t3" else n) for k, n in rows if run == 3 or k != "t5"]
    if run == 3:
        rows.append(("t99", "new"))
    return spark.createDataFrame([(k, n, dt.datetime(1990, 1, 1)) for k, n in rows], "thing_bk string, name string, last_edited_time timestamp_ntz")


def sales(spark, run):
    """A sale a day over 2026; run 2 changes one amount and moves one date, run 3 deletes one and adds one."""
    rows = {f"s{i}": (10 * i, dt.date(2026, 1, 1) + dt.timedelta(days=i % 120), f"t{i % 23}") for i in range(600)}
    if run >= 2:
        rows["s7"] = (1, *rows["s7"][1:])
        rows["s8"] = (rows["s8"][0], None, rows["s8"][2])
    if run == 3:
        del rows["s9"]
        rows["s1000"] = (5, dt.date(2026, 3, 5), "t99")
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], "sale_bk string, amount int, sold date, thing string")


@pytest.fixture
def store(spark):
    return TableStore(spark, new_scratch_path(spark, "feed"), prefix=f"f{uuid.uuid4().hex[:8]}_")


def files(table):
    return {s: {(f, os.path.getmtime(f)) for f in glob.glob(f"{d.removeprefix('file:')}/*.parquet")} for s, d in table.manifest().items()}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def run_all(spark, store, upto=3):
    """The snapshot kept in the store, its feed read from there."""
    out = []
    for run in range(1, upto + 1):
        c = RunContext(run, RUNS[run - 1], run == 1)
        now = things(spark, run)
        current = store.read_snapshot("dim_thing", open_only=True)
        changes = scd2_merge(None, now, DIM, c) if current is None else scd2_changes(current, now, DIM, c, strategy="wide")
        store.publish_snapshot(changes, "dim_thing", run)
        dims = {"dim_thing": store.read_snapshot("dim_thing")}
        feeds = {} if run == 1 else {"dim_thing": I.snapshot_feed(store, "dim_thing", "thing_bk", c)}
        done = I.fact_load(store, SPEC, sales(spark, run), dims, feeds, c, buckets=BUCKETS)
        out.append((done, dims, feeds))
    return out


def test_equals_a_full_build_after_three_runs(spark, store):
    loads = run_all(spark, store)
    full = build_fact(sales(spark, 3), loads[-1][1], SPEC)
    got = I.read_fact(store, SPEC)
    assert got.columns == full.columns and rows_of(got) == rows_of(full)
    assert [r[0] for r in rows_of(loads[1][2]["dim_thing"])] == ["t3", "t5"]
    assert [r[0] for r in rows_of(loads[2][2]["dim_thing"])] == ["t5", "t99"]
    # run 2: two changed sales, and those of t3 and t5 from its date on; run 3: the new sale, those of t5 from its date on
    days = {f"s{i}": (dt.date(2026, 1, 1) + dt.timedelta(days=i % 120), i % 23) for i in range(600)}
    second = {"s7", "s8"} | {k for k, (d, t) in days.items() if t in (3, 5) and d >= dt.date(2026, 2, 1)}
    third = {"s1000"} | {k for k, (d, t) in days.items() if t == 5 and d >= dt.date(2026, 3, 1) and k != "s9"}
    assert loads[1][0].loaded == len(second) and loads[2][0].loaded == len(third) and loads[2][0].deleted == 1


def test_untouched_buckets_keep_their_files(spark, store):
    run_all(spark, store, 1)
    table = BucketedTable(store, "warehouse", "fact_sale", "sale_bk")
    before = files(table)
    c = RunContext(2, RUNS[1])
    dims = {"dim_thing": store.read_snapshot("dim_thing")}
    one = sales(spark, 1).withColumn("amount", F.when(F.col("sale_bk") == "s7", 1).otherwise(F.col("amount")))
    done = I.fact_load(store, SPEC, one, dims, {}, c)
    after = files(table)
    assert done.loaded == 1 and len(done.slots) == 1 and {s for s in after if after[s] != before[s]} == set(done.slots)
    assert I.fact_load(store, SPEC, one, dims, {}, c).slots == ()          # nothing changed: nothing written
    assert files(table) == after


def test_a_new_unknown_member_rebuilds_all(spark, store):
    run_all(spark, store, 1)
    c = RunContext(2, RUNS[1])
    renamed = things(spark, 1).withColumn("name", F.when(F.col("thing_bk") == "-1", "nobody").otherwise(F.col("name")))
    store.publish_snapshot(scd2_changes(store.read_snapshot("dim_thing", open_only=True), renamed, DIM, c, strategy="wide"), "dim_thing", 2)
    # one open version of the unknown member, as the fact asks for
    dims = {"dim_thing": store.read_snapshot("dim_thing").filter("not (thing_bk = '-1' and scd2_valid_to < '9999-01-01')")}
    feeds = {"dim_thing": I.snapshot_feed(store, "dim_thing", "thing_bk", c)}
    done = I.fact_load(store, SPEC, sales(spark, 1), dims, feeds, c)
    assert done.loaded == 600 and rows_of(I.read_fact(store, SPEC)) == rows_of(build_fact(sales(spark, 1), dims, SPEC))


def test_the_hash_tells_nulls_from_values(spark):
    rows = spark.createDataFrame([("1", None), (None, "1"), ("1", "1"), (None, None)], "a string, b string")
    assert rows.select(I.source_hash(["a", "b"]).alias("h")).distinct().count() == 4
