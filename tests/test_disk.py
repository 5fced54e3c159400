"""What a job leaves on disk: no cached rows beside what is written, a slice or a table shuffled at a time."""

import datetime as dt
import os
import uuid
from collections import Counter

import pytest
from pyspark.sql import DataFrame

from ledgerlake.operators.scd2 import scd2_changes, scd2_merge
from ledgerlake.plans import jobs
from ledgerlake.plans.jobs import BuildResult, _run_all, key_slices, run_checks
from ledgerlake.plans.specs import ACCOUNT
from ledgerlake.session import new_scratch_path, scratch_dir
from ledgerlake.sources.pages import land_responses, to_pages
from ledgerlake.sources.store import TableStore
from ledgerlake.spec import Check, RunContext, SnapshotSpec
from test_landing import accounts

AT = dt.datetime(1994, 6, 1)


def _store(spark) -> TableStore:
    return TableStore(spark, new_scratch_path(spark, "store"), prefix=f"d{uuid.uuid4().hex[:8]}_")


def _bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture
def no_cache(monkeypatch):
    def refuse(*a, **b):
        raise AssertionError("rows are cached beside what is written")
    monkeypatch.setattr(DataFrame, "persist", refuse)
    monkeypatch.setattr(DataFrame, "cache", refuse)


def test_entity_load_keeps_no_scratch(spark, no_cache):
    store, path = _store(spark), new_scratch_path(spark, "landed")
    land_responses(to_pages(accounts(spark, 30), ACCOUNT), path)
    done = jobs.entity_load(store, ACCOUNT, path, RunContext(1, "2026-01-01 00:00:00"))
    assert (done.extracted, done.deleted) == (30, 0) and store.read("raw", "account").count() == 30
    assert not [f for f in os.listdir(scratch_dir(spark).removeprefix("file:") + "/ledgerlake") if f.startswith("mapped-account")]


SPEC = SnapshotSpec("dim_x", "stg_x", "k", ("k", "v"))


def _source(spark, rows):
    return spark.createDataFrame([(k, v, AT) for k, v in rows], "k string, v int, last_edited_time timestamp_ntz")


def test_snapshot_in_slices_is_the_whole_snapshot(spark, no_cache):
    """Parts of any number give the history that one merge gives; a segment without rows can be read."""
    runs = [[(str(i), 1) for i in range(40)] + [(None, 1)], [(str(i), i % 3) for i in range(5, 50)] + [(None, 2)],
            [(str(i), i % 3) for i in range(5, 50)]]
    whole, store = None, _store(spark)
    for run, rows in enumerate(runs, 1):
        ctx, now = RunContext(run, f"2026-0{run}-01 00:00:00"), _source(spark, rows)
        whole = scd2_merge(whole, now, SPEC, ctx, strategy="wide")
        current = store.read_snapshot("dim_x", open_only=True)
        slices = key_slices("k", len(rows), slice_rows=10, most=3)
        assert len(slices) == 3
        parts = (scd2_merge(None, p(now), SPEC, ctx) if current is None
                 else scd2_changes(p(current), p(now), SPEC, ctx, strategy="wide") for p in slices)
        assert store.publish_snapshot(parts, "dim_x", run, ctx.run_ts)
        assert _bag(store.read_snapshot("dim_x")) == _bag(whole)
        assert store.rows("warehouse", "dim_x") == whole.count()
        assert store.snapshot_open_rows("dim_x") == whole.filter("scd2_valid_to > '9000-01-01'").count()
        assert store.snapshot_begun("dim_x", run) == whole.filter(f"scd2_valid_from = '{ctx.run_ts}'").count()
    assert store.read_closed("dim_x", 1).count() == store.read_closed("dim_x", 3).count() == 0
    assert len(key_slices("k", 10)) == 1 and len(key_slices("k", 10 ** 9)) == jobs.MAX_SLICES


def test_large_items_run_alone():
    import threading
    import time
    now, seen, lock = [0], {}, threading.Lock()

    def fn(x):
        with lock:
            now[0] += 1
        time.sleep(0.1)
        seen[x] = now[0]
        with lock:
            now[0] -= 1
        return x * 10
    assert _run_all(fn, [1, 2, 3, 4, 5], 4, lambda x: x in (2, 4)) == [10, 20, 30, 40, 50]
    assert seen[2] == seen[4] == 1 and max(seen[1], seen[3], seen[5]) > 1


def test_checks_are_summed_a_table_at_a_time(spark, monkeypatch):
    seen = []
    plain = jobs.Q.summary
    monkeypatch.setattr(jobs.Q, "summary", lambda checks, *a: seen.append({c.table for c in checks}) or plain(checks, *a))
    a, b = _source(spark, [("1", 1), ("1", None)]), _source(spark, [("1", 1)])
    checks = [Check("u_a", "a", "unique", ("k",)), Check("u_b", "b", "unique", ("k",)), Check("n_a", "a", "not_null", ("v",)),
              Check("fk_a", "a", "foreign_key", ("k",), parent="b", parent_columns=("k",))]
    store, res = _store(spark), BuildResult()
    assert run_checks(store, checks, {"a": a, "b": b}, res) == {"a"}
    assert seen == [{"a"}, {"b"}]
    assert {r["test_name"]: r["failures"] for r in res.summaries[0]} == {"u_a": 1, "n_a": 1, "fk_a": 0, "u_b": 0}
    assert store.read(jobs.FAILURES_SCHEMA, "n_a").count() == 1

