import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.scd2 import scd2_merge
from ledgerlake.session import new_scratch_path
from ledgerlake.spec import RunContext, SnapshotSpec
from ledgerlake.streaming import history as H

SPEC = SnapshotSpec("dim_thing", "stg", "bk", ("bk", "name", "due"))
SCHEMA = "bk string, name string, due date, extra int, last_edited_time timestamp_ntz"
RUNS = ["2026-01-01 00:00:00", "2026-02-01 12:30:00", "2026-03-01 00:00:00", "2026-04-01 00:00:00"]
D = dt.date(2026, 5, 5)
T = dt.datetime(2025, 1, 1)
STATES = [
    [("a", "x", None, 1, T), ("b", "y", D, 1, T), ("c", "z", None, 1, T)],
    [("a", "x", None, 2, T), ("b", "y", None, 2, T), ("d", "new", D, 1, T)],        # a frozen, b changed to null, c gone
    [("a", "x2", D, 3, T), ("c", "z", None, 3, T)],                                   # b and d gone, c back
    [("a", "x2", D, 4, T), ("c", "z", None, 4, T), ("b", "y", None, 4, T)],
]


def source(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def changes(spark):
    before = None
    for rows, ts in zip(STATES, RUNS):
        now = source(spark, rows)
        yield H.changes_between(before, now, "bk", ts)
        before = now


def merged(spark, initial=False):
    hist = None
    for i, (rows, ts) in enumerate(zip(STATES, RUNS)):
        hist = scd2_merge(hist, source(spark, rows), SPEC, RunContext(i + 1, ts, initial and i == 0), strategy="wide")
    return hist


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def read(spark, landed, schema, chk, out, **kw):
    q = H.start_history(spark, landed, schema, SPEC, out, chk, **kw)
    q.awaitTermination()
    return spark.read.parquet(out)


@pytest.fixture
def paths(spark):
    return [new_scratch_path(spark, f"hist-{x}") for x in ("landed", "out", "chk")]


@pytest.mark.parametrize("each_alone", [True, False])
def test_rows_of_the_merge(spark, paths, each_alone):
    """Run by run through a stream that stops and starts again, or all runs in one micro-batch."""
    landed, out, chk = paths
    for i, c in enumerate(changes(spark)):
        H.land(c, landed, i + 1)
        if each_alone:
            read(spark, landed, c.schema, chk, out)
    events = read(spark, landed, c.schema, chk, out)
    want = merged(spark)
    got = H.history_of(events, SPEC)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    assert events.filter("event = 'late'").count() == 0
    # nothing new: nothing comes out
    n = events.count()
    assert read(spark, landed, c.schema, chk, out).count() == n


def test_replayed_and_late_states_change_nothing(spark, paths):
    landed, out, chk = paths
    own = list(changes(spark))
    for i, c in enumerate(own):
        H.land(c, landed, i + 1)
        read(spark, landed, c.schema, chk, out)
    before = rows_of(H.history_of(spark.read.parquet(out), SPEC))
    H.land(own[2], landed, 77)                                   # a run's file once more, under another name
    late = source(spark, [("a", "from an earlier run", None, 9, T), ("new", "first seen", None, 9, T)])
    H.land(H.changes_between(None, late, "bk", RUNS[1]), landed, 78)
    events = read(spark, landed, own[0].schema, chk, out)
    after = rows_of(H.history_of(events, SPEC))
    assert [r for r in after if r[0] != "new"] == before and len(after) == len(before) + 1
    # c, a, and the tombstones of b and d; then the state of a that came too late
    assert events.filter("event = 'late'").count() == own[2].count() + 1


def test_initial_load_dates(spark, paths):
    landed, out, chk = paths
    first = source(spark, STATES[0])
    H.land(H.initial_changes(first), landed, 1)
    c = H.changes_between(first, source(spark, STATES[1]), "bk", RUNS[1])
    H.land(c, landed, 2)
    hist = scd2_merge(None, first, SPEC, RunContext(1, RUNS[0], True))
    hist = scd2_merge(hist, source(spark, STATES[1]), SPEC, RunContext(2, RUNS[1]), strategy="wide")
    assert rows_of(H.history_of(read(spark, landed, c.schema, chk, out), SPEC)) == rows_of(hist)


def test_null_keys_and_two_states_in_one_run(spark, paths):
    landed, out, chk = paths
    c = H.changes_between(None, source(spark, [(None, "n", None, 1, T), ("a", "p", None, 1, T), ("a", "q", None, 1, T)]), "bk", RUNS[0])
    H.land(c, landed, 1)
    events = read(spark, landed, c.schema, chk, out)
    assert [(r["bk"], r["name"], r["event"]) for r in events.orderBy("event").collect()] == [("a", "p", "late"), ("a", "q", "open")]


def test_a_tombstone_of_an_unknown_key(spark, paths):
    landed, out, chk = paths
    c = H.changes_between(source(spark, STATES[0]), source(spark, []), "bk", RUNS[1])
    assert c.filter(F.col(H.GONE)).count() == 3 == c.count()
    H.land(c, landed, 1)
    assert read(spark, landed, c.schema, chk, out).count() == 0


def test_keys_share_states_by_bucket(spark, paths, monkeypatch):
    """Python is called once for a bucket of keys, not for each key; a key's history is the same in any company."""
    monkeypatch.setattr(H, "BUCKETS", 2)
    landed, out, chk = paths
    for i, c in enumerate(changes(spark)):
        H.land(c, landed, i + 1)
        q = H.start_history(spark, landed, c.schema, SPEC, out, chk)
        q.awaitTermination()
    assert 1 <= q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    assert rows_of(H.history_of(spark.read.parquet(out), SPEC)) == rows_of(merged(spark))
