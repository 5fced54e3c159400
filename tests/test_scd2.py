import datetime as dt

import pytest

from ledgerlake.operators.scd2 import scd2_merge
from planutil import plan_text
from ledgerlake.spec import RunContext, SnapshotSpec

SPEC = SnapshotSpec("dim_t", "stg_t", "k", ("k", "name"))
SCHEMA = "k string, name string, created_time timestamp_ntz, last_edited_time timestamp_ntz"
OPEN = dt.datetime(9999, 12, 31)
E1, E2 = dt.datetime(1990, 1, 1), dt.datetime(2026, 1, 5)
R1, R2, R3 = "2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00"


def ctx(ts, initial=False):
    return RunContext(1, ts, initial)


def _key(t):
    return tuple("" if v is None else str(v) for v in t)


def rows(df):
    return sorted(((r["k"], r["name"], r["created_time"], r["scd2_valid_from"], r["scd2_valid_to"])
                   for r in df.collect()), key=_key)


def src(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(params=["wide", "narrow"])
def strategy(request, monkeypatch):
    import ledgerlake.operators.scd2 as m
    orig = m.scd2_changes
    monkeypatch.setattr(m, "scd2_changes", lambda *a, **kw: orig(*a, **{**kw, "strategy": request.param}))
    return request.param


def test_initial_and_all_cases(spark, strategy):
    t1 = dt.datetime(2026, 1, 1)
    t2 = dt.datetime(2026, 2, 1)
    s1 = src(spark, [("a", "A", E1, E1), ("b", "B", E1, E1), ("c", "C", E1, E1), ("d", None, E1, E1)])
    h1 = scd2_merge(None, s1, SPEC, ctx(R1))
    assert rows(h1) == sorted([(k, n, E1, t1, OPEN) for k, n in (("a", "A"), ("b", "B"), ("c", "C"), ("d", None))],
                              key=_key)
    # a unchanged but unchecked column edited (frozen); b changed; c deleted; d changed from null; e new
    s2 = src(spark, [("a", "A", E2, E2), ("b", "B2", E2, E2), ("d", "D", E2, E2), ("e", "E", E2, E2)])
    h2 = scd2_merge(h1, s2, SPEC, ctx(R2))
    assert rows(h2) == sorted([
        ("a", "A", E1, t1, OPEN),
        ("b", "B", E1, t1, t2), ("b", "B2", E2, t2, OPEN),
        ("c", "C", E1, t1, t2),
        ("d", None, E1, t1, t2), ("d", "D", E2, t2, OPEN),
        ("e", "E", E2, t2, OPEN)], key=_key)
    # c comes back: a new version; closed versions pass through untouched
    t3 = dt.datetime(2026, 3, 1)
    s3 = src(spark, [("a", "A", E2, E2), ("b", "B2", E2, E2), ("c", "C", E1, E2), ("d", "D", E2, E2),
                     ("e", "E", E2, E2)])
    h3 = scd2_merge(h2, s3, SPEC, ctx(R3))
    assert rows(h3) == sorted(rows(h2) + [("c", "C", E1, t3, OPEN)], key=_key)
    assert h3.select("dk").distinct().count() == h3.count()


def test_initial_load_uses_last_edited_time(spark):
    s = src(spark, [("a", "A", E1, E1)])
    h = scd2_merge(None, s, SPEC, ctx(R1, initial=True))
    r = h.first()
    assert r["scd2_valid_from"] == E1 and r["scd2_updated_at"] == E1 and r["scd2_valid_to"] == OPEN


def test_merge_plan_shapes(spark):
    from ledgerlake.operators.scd2 import scd2_changes
    s1 = src(spark, [("a", "A", E1, E1), ("b", "B", E1, E1)])
    first = scd2_merge(None, s1, SPEC, ctx(R1))
    hist = spark.createDataFrame(first.collect(), first.schema)
    s2 = src(spark, [("a", "A2", E1, E1)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = plan_text(scd2_changes(hist, s2, SPEC, ctx(R2), strategy="wide"))
        narrow = plan_text(scd2_changes(hist, s2, SPEC, ctx(R2), strategy="narrow"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # wide: one full outer join, one exchange per side
    assert "FullOuter" in wide and wide.count("Exchange hashpartitioning") == 2
    # narrow: the affected keys were found (narrow, checkpointed) beforehand; the
    # open versions meet only their broadcast set, so no wide row is shuffled
    assert "Exchange hashpartitioning" not in narrow and "BroadcastHashJoin" in narrow
    for p in (wide, narrow):
        assert "PythonUDF" not in p and "BatchEvalPython" not in p


def test_history_missing_columns_raises(spark):
    with pytest.raises(ValueError):
        scd2_merge(src(spark, [("a", "A", E1, E1)]), src(spark, [("a", "A", E1, E1)]), SPEC, ctx(R1))


def test_guards(spark):
    dup = src(spark, [("a", "A", E1, E1), ("a", "B", E1, E1)])
    with pytest.raises(ValueError, match="duplicated"):
        scd2_merge(None, dup, SPEC, ctx(R1), validate=True)
    nullk = src(spark, [(None, "A", E1, E1)])
    with pytest.raises(ValueError, match="null"):
        scd2_merge(None, nullk, SPEC, ctx(R1), validate=True)
    h = scd2_merge(None, src(spark, [("a", "A", E1, E1)]), SPEC, ctx(R1))
    with pytest.raises(ValueError, match="initial load"):
        scd2_merge(h, src(spark, [("a", "A", E1, E1)]), SPEC, ctx(R2, initial=True))


def test_segmented_snapshot_store(spark):
    from ledgerlake.operators.scd2 import scd2_changes
    from ledgerlake.session import new_scratch_path
    from ledgerlake.sources.store import TableStore
    from planutil import plan_text
    store = TableStore(spark, new_scratch_path(spark, "snap-store"), prefix="snap_")
    s1 = src(spark, [("a", "A", E1, E1), ("b", "B", E1, E1), ("c", "C", E1, E1)])
    s2 = src(spark, [("a", "A", E1, E1), ("b", "B2", E2, E2)])
    assert store.publish_snapshot(scd2_merge(None, s1, SPEC, ctx(R1)), "dim_t", 1)
    ch2 = scd2_changes(store.read_snapshot("dim_t", open_only=True), s2, SPEC, ctx(R2))
    assert store.publish_snapshot(ch2, "dim_t", 2)
    full = store.read_snapshot("dim_t")
    assert _bag_rows(full) == _bag_rows(scd2_merge(scd2_merge(None, s1, SPEC, ctx(R1)), s2, SPEC, ctx(R2)))
    # a run already committed is not applied twice
    assert not store.publish_snapshot(ch2, "dim_t", 2)
    assert full.count() == 4
    # the open read touches only the open partition
    plan = plan_text(store.read_snapshot("dim_t", open_only=True), "formatted")
    assert "PartitionFilters" in plan and "open" in plan
    # an unfinished run (closed partition registered, open not repointed) is rolled back
    name = f"{store.db('warehouse')}.dim_t"
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (scd2_segment = 'c3') "
              f"LOCATION '{store.root}/warehouse/dim_t/closed/run=2'")
    ch3 = scd2_changes(store.read_snapshot("dim_t", open_only=True), s2, SPEC, ctx(R3))
    assert store.publish_snapshot(ch3, "dim_t", 3)
    assert store.read_snapshot("dim_t").count() == 4


def _bag_rows(df):
    from collections import Counter
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_null_keys_same_in_both_strategies(spark):
    from ledgerlake.operators.scd2 import scd2_changes
    h = scd2_merge(None, src(spark, [("a", "A", E1, E1), (None, "N", E1, E1)]), SPEC, ctx(R1))
    s2 = src(spark, [("a", "A2", E2, E2), (None, "M", E2, E2)])
    wide = _bag_rows(scd2_changes(h, s2, SPEC, ctx(R2), strategy="wide"))
    narrow = _bag_rows(scd2_changes(h, s2, SPEC, ctx(R2), strategy="narrow"))
    assert wide == narrow
