"""Incomplete pulls, empty live sets, interrupted publishes and lossless bronze."""

import datetime as dt
import glob
import os
from collections import Counter

import pytest

from ledgerlake.operators.load import EmptyLiveSet, sync_deletes
from ledgerlake.operators.scd2 import scd2_changes, scd2_merge
from ledgerlake.plans import queries as Qs
from ledgerlake.plans.jobs import AUDIT_TABLE, entity_load
from ledgerlake.plans.specs import ENTITIES
from ledgerlake.session import new_scratch_path
from ledgerlake.sources.bronze import read_bronze, register_bronze, write_bronze
from ledgerlake.sources.pages import IncompletePull
from ledgerlake.sources.store import TableStore
from ledgerlake.spec import RunContext, SnapshotSpec

SPEC = ENTITIES["subcategory"]


def bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def landed_text(spark, lines):
    path = new_scratch_path(spark, "landed-text")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


@pytest.fixture(scope="module")
def loaded(spark, sf):
    store = Qs.new_store(spark)
    entity_load(store, SPEC, Qs.landed(spark, sf, "subcategory", 1), Qs.ctx(1))
    return store


def state(store):
    return (store.location("raw", SPEC.name), bag(store.read("raw", SPEC.name)),
            bag(store.read("raw", AUDIT_TABLE).filter(f"source_name = '{SPEC.name}'")), bag(store.read("warehouse", "sys_etl_stats")))


PAGE = '{"id":"k1","created_time":"2026-01-01T00:00:00.000Z","last_edited_time":"2026-01-01T00:00:00.000Z","properties":{}}'
FIRST = '{"object":"list","results":[' + PAGE + '],"has_more":true,"next_cursor":"c"}'
LAST = '{"object":"list","results":[],"has_more":false,"next_cursor":null}'


@pytest.mark.parametrize("lines", [[FIRST, LAST[:30]], [FIRST], [FIRST, '{"object":"error","has_more":false}']])
def test_incomplete_pull_changes_nothing(spark, loaded, lines):
    before = state(loaded)
    with pytest.raises(Exception) as e:
        entity_load(loaded, SPEC, landed_text(spark, lines), Qs.ctx(2))
    assert isinstance(e.value, IncompletePull) or "MALFORMED" in str(e.value)
    assert state(loaded) == before


def test_empty_pull_needs_leave(spark, sf):
    store = Qs.new_store(spark)
    entity_load(store, SPEC, Qs.landed(spark, sf, "subcategory", 1), Qs.ctx(1))
    before, n = state(store), store.rows("raw", SPEC.name)
    with pytest.raises(EmptyLiveSet):
        entity_load(store, SPEC, landed_text(spark, [LAST]), Qs.ctx(2))
    assert state(store) == before
    counts = entity_load(store, SPEC, landed_text(spark, [LAST]), Qs.ctx(2), allow_empty=True)
    assert (counts.extracted, counts.deleted) == (0, n) and store.read("raw", SPEC.name).count() == 0


def test_run_without_change_writes_nothing(spark, sf, loaded):
    before = loaded.location("raw", SPEC.name)
    counts = entity_load(loaded, SPEC, Qs.landed(spark, sf, "subcategory", 1), Qs.ctx(1))
    assert (counts.extracted, counts.deleted) == (0, 0) and loaded.location("raw", SPEC.name) == before


@pytest.mark.parametrize("size", [None, 1])
def test_sync_deletes_both_ways(spark, size):
    target = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)], "id string, v int")
    live = spark.createDataFrame([("a",), ("c",), (None,)], "id string")
    kept, deleted = sync_deletes(target, live, target_rows=size)
    assert sorted(r["v"] for r in kept.collect()) == [1, 2, 5] and deleted == 2
    with pytest.raises(EmptyLiveSet):
        sync_deletes(target, live.filter("false"), target_rows=size, allow_empty=False)
    kept, deleted = sync_deletes(target, live.filter("false"), target_rows=size)
    assert kept.count() == 0 and deleted == 5
    assert sync_deletes(target.filter("false"), live, target_rows=size)[1] == 0


@pytest.mark.parametrize("stop", ["CREATE TABLE", "SET TBLPROPERTIES", "SET LOCATION"])
def test_publish_survives_a_stop_after_any_statement(spark, monkeypatch, stop):
    root = new_scratch_path(spark, "stop-test")
    prefix = f"st{abs(hash(root)) % 10**8}_"
    store = TableStore(spark, root, prefix=prefix)
    row = lambda x: spark.createDataFrame([(x,)], "id string")
    if stop != "CREATE TABLE":
        store.publish(row("a"), "raw", "t")
    real = spark.sql

    def broken(text, *a, **k):
        out = real(text, *a, **k)
        if stop in text:
            raise RuntimeError("stopped")
        return out

    monkeypatch.setattr(spark, "sql", broken)
    with pytest.raises(RuntimeError):
        store.publish(store.read_or_empty("raw", "t", row("x").schema).unionByName(row("b")), "raw", "t")
    monkeypatch.undo()
    seen = sorted(r["id"] for r in TableStore(spark, root, prefix=prefix).read("raw", "t").collect())
    assert seen == {"CREATE TABLE": ["b"], "SET TBLPROPERTIES": ["a"], "SET LOCATION": ["a", "b"]}[stop]
    again = TableStore(spark, root, prefix=prefix)
    assert again.rows("raw", "t") in (None, len(seen))
    again.publish(again.read("raw", "t").unionByName(row("c")), "raw", "t")
    assert sorted(r["id"] for r in again.read("raw", "t").collect()) == sorted(seen + ["c"]) and again.rows("raw", "t") == len(seen) + 1


def test_old_versions_go(spark):
    root = new_scratch_path(spark, "old-test")
    store = TableStore(spark, root, prefix="old_")
    for k in range(4):
        store.publish(spark.range(k + 1), "raw", "t")
    left = sorted(os.path.basename(p)[:8] for p in glob.glob(f"{root.removeprefix('file://')}/raw/t/v=*"))
    assert left == ["v=000003", "v=000004"] and store.read("raw", "t").count() == 4


def test_both_merge_plans_see_the_same_changes(spark):
    spec = SnapshotSpec("dim_t", "stg_t", "k", ("k", "t", "x"))
    schema = "k string, t timestamp, x double, created_time timestamp_ntz, last_edited_time timestamp_ntz"
    e = dt.datetime(2026, 1, 1)
    t = dt.datetime(2026, 1, 1, 0, 0, 0, 5)
    old = spark.createDataFrame([("a", t, 0.0, e, e), ("b", t, 1.0, e, e), ("n", None, None, e, e), (None, t, 1.0, e, e)], schema)
    new = spark.createDataFrame([("a", t, -0.0, e, e), ("b", t + dt.timedelta(microseconds=1), 1.0, e, e), ("n", None, None, e, e),
                                 (None, t, 2.0, e, e), ("d", t, 1.0, e, e)], schema)
    history = scd2_merge(None, old, spec, RunContext(1, "2026-01-01 00:00:00", False))
    out = {s: bag(scd2_changes(history, new, spec, RunContext(2, "2026-02-01 00:00:00", False), strategy=s)) for s in ("wide", "narrow")}
    assert out["wide"] == out["narrow"]
    rows = scd2_changes(history, new, spec, RunContext(2, "2026-02-01 00:00:00", False), strategy="narrow").collect()
    assert Counter(r["k"] for r in rows) == {"a": 1, "b": 2, "n": 1, "d": 1}


def test_bronze_keeps_every_text(spark):
    root = new_scratch_path(spark, "bronze-text")
    texts = ["  lead", "trail  ", "", None, 'a "quoted", text', "two\nlines", "cr\r\nlf", "back\\slash", "'", " ", "null", "\t"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, note string")
    write_bronze(df, root, "e", 1)
    want = dict(enumerate(texts))
    assert {int(r["id"]): r["note"] for r in read_bronze(spark, root, "e", df.schema).collect()} == want
    register_bronze(spark, root, "e", df.schema, "bronze_texts")
    assert {int(r["id"]): r["note"] for r in spark.table("bronze_texts").collect()} == want


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    from ledgerlake import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.scratch_dir(Session())
