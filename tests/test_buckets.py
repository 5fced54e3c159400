import datetime as dt
import glob
import os
import uuid

import pytest
from planutil import plan_text
from pyspark.sql import functions as F

from ledgerlake.operators.load import EmptyLiveSet, hard_delete, upsert
from ledgerlake.session import new_scratch_path
from ledgerlake.sources.buckets import SLOT, BucketedTable, bucket_count, slot_of
from ledgerlake.sources.store import TableStore

SCHEMA = "id string, v int, load_date timestamp_ntz"
T1, T2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)


@pytest.fixture
def store(spark):
    return TableStore(spark, new_scratch_path(spark, "buckets"), prefix=f"b{uuid.uuid4().hex[:8]}_")


def base(spark, n=2000):
    rows = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("v"), F.lit(T1).cast("timestamp_ntz").alias("load_date"))
    return rows.unionByName(spark.createDataFrame([(None, -1, T1)], SCHEMA))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(table):
    """Path, size and time of every data file of the current version, by slot."""
    out = {}
    for slot, d in table.manifest().items():
        out[slot] = {(f, os.path.getsize(f), os.path.getmtime(f)) for f in glob.glob(f"{d.removeprefix('file:')}/*.parquet")}
    return out


def test_upsert_writes_only_touched_buckets(spark, store):
    table = BucketedTable(store, "raw", "t", buckets=32)
    table.load(base(spark))
    before = files(table)
    assert len(before) == 32 and all(len(f) == 1 for f in before.values())
    # 1 % of the keys, all in two of the buckets
    batch = (base(spark).filter(slot_of("id", 32).isin(3, 17) & F.col("id").isNotNull()).limit(20)
             .withColumns({"v": F.lit(1), "load_date": F.lit(T2).cast("timestamp_ntz")}))
    batch = spark.createDataFrame(batch.collect() * 1 + [("new", 2, T2), ("new", 3, T2)], SCHEMA)
    touched = {r[0] for r in batch.select(slot_of("id", 32)).distinct().collect()}
    done = table.load(batch)
    after = files(table)
    assert set(done.slots) == touched and done.loaded == 22 and len(touched) <= 3
    assert {s for s in after if after[s] != before[s]} == touched
    assert rows_of(table.read()) == rows_of(upsert(base(spark), batch))
    assert table.rows() == table.read().count() == 2003 and table.watermark().startswith("2026-02-01")


def test_joins_have_no_exchange(spark, store):
    table = BucketedTable(store, "raw", "t", buckets=8)
    table.load(base(spark))
    new, _, facts = table.stage(base(spark).limit(50), "batch")
    alive, _, more = table.stage(base(spark).select("id"), "live")
    for part in table.next_rows(new, alive, [1, 2, 5]):
        plan = plan_text(part)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and f"{SLOT}#" in plan
    plan = plan_text(table.kept(new, [1, 2]))
    assert "PartitionFilters: [slot" in plan and "Bucketed: true" in plan
    table.unstage(facts)
    table.unstage(more)


def test_load_with_deletes(spark, store):
    table = BucketedTable(store, "raw", "t", buckets=16)
    table.load(base(spark))
    before = files(table)
    batch = spark.createDataFrame([("5", 1, T2), ("gone at once", 1, T2)], SCHEMA)
    live = base(spark).select("id").filter("id not in ('7', '8')")
    done = table.load(batch, live)
    kept, removed = hard_delete(upsert(base(spark), batch), live)
    assert rows_of(table.read()) == rows_of(kept) and done.deleted == removed.count() == 4      # 7, 8, the null key, the new one
    after = files(table)
    assert {s for s in before if after.get(s) != before[s]} == set(done.slots) and len(done.slots) <= 5
    number = table.head()["number"]
    assert table.load(spark.createDataFrame([], SCHEMA), live) .slots == () and table.head()["number"] == number     # no news, no version


def test_empty_tables_and_slots(spark, store):
    table = BucketedTable(store, "raw", "t", buckets=4)
    assert table.read() is None and table.head() is None and table.manifest() == {}
    table.load(spark.createDataFrame([], SCHEMA))
    assert table.read().count() == 0 and table.rows() == 0
    table.load(base(spark, 10))
    with pytest.raises(EmptyLiveSet):
        table.load(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "id string"), allow_empty=False)
    assert table.rows() == 11
    done = table.load(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "id string"))
    assert done.deleted == 11 and table.read().count() == 0 and table.manifest() == {}
    table.load(base(spark, 3))
    assert table.rows() == 4


def test_a_load_that_stops_leaves_the_old_version(spark, store, monkeypatch):
    table = BucketedTable(store, "raw", "t", buckets=4)
    table.load(base(spark, 100))
    old = rows_of(table.read())
    real = BucketedTable._commit
    for when in ("before", "between"):
        def stop(self, fields, manifest, rows, wm, when=when):
            if when == "between":
                self._create(f"{self.table}__v000099_aaaaaa", fields, f"{self.root}/_versions/x")   # not named by the head
            raise RuntimeError("lost")
        monkeypatch.setattr(BucketedTable, "_commit", stop)
        with pytest.raises(RuntimeError):
            table.load(spark.createDataFrame([("1", 9, T2)], SCHEMA))
        monkeypatch.setattr(BucketedTable, "_commit", real)
        assert rows_of(BucketedTable(store, "raw", "t").read()) == old
    table = BucketedTable(store, "raw", "t")
    table.load(spark.createDataFrame([("1", 9, T2)], SCHEMA))
    assert {r["id"]: r["v"] for r in table.read().collect()}["1"] == 9 and table.rows() == 101
    left = {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {store.db('raw')}").collect()}
    assert left == {"t__head", *[t for t in left if t.startswith("t__v00000")]} and len(left) == 3
    used = {d.split("/")[-2] for n in left if "__v" in n for d in table.manifest(n).values()}
    assert {os.path.basename(d) for d in glob.glob(f"{table.root.removeprefix('file:')}/[a-z]*")} == used


def test_more_buckets(spark, store):
    table = BucketedTable(store, "raw", "t", buckets=2)
    table.load(base(spark, 500))
    table.replace(table.read(), buckets=8)
    table = BucketedTable(store, "raw", "t")
    assert table.buckets == 8 and len(table.manifest()) == 8 and rows_of(table.read()) == rows_of(base(spark, 500))
    table.load(spark.createDataFrame([("1", 9, T2)], SCHEMA))
    assert table.rows() == 501
    assert [bucket_count(n, 100) for n in (0, 100, 101, 250, 10**9)] == [1, 1, 2, 4, 65536]


def test_the_store_reads_a_bucketed_table_like_any_other(spark, store):
    table = BucketedTable(store, "raw", "t", buckets=4)
    table.load(base(spark, 20))
    assert store.exists("raw", "t") and store.rows("raw", "t") == 21 and store.read("raw", "t").count() == 21
    assert store.watermark("raw", "t")[1].startswith("2026-01-01")
    store.publish(store.read("raw", "t").withColumn("v", F.lit(5)), "raw", "t")
    assert {r["v"] for r in store.read("raw", "t").collect()} == {5} and len(BucketedTable(store, "raw", "t").manifest()) == 4
