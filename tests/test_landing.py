"""Landed responses: packed, whole, and gone when they are read no more."""

import datetime as dt
import os
from collections import Counter

from pyspark.sql import functions as F

from ledgerlake.plans import queries as Qs
from ledgerlake.plans.specs import ACCOUNT, ENTITIES
from ledgerlake.session import new_scratch_path, scratch_dir
from ledgerlake.sources.pages import land_many, land_responses, map_pages, read_pages, read_responses, to_pages

AT = dt.datetime(1994, 6, 1)


def _bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def accounts(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("Accъ "), "id")).alias("title"),
                                 (F.col("id") % 2 == 0).alias("is_archived"), F.lit(AT).cast("timestamp_ntz").alias("created_time"),
                                 F.lit(AT).cast("timestamp_ntz").alias("last_edited_time"))


def _files(path):
    path = path.removeprefix("file:")
    return [f"{d}/{f}" for d, _, fs in os.walk(path) for f in fs if not f.startswith((".", "_"))]


def test_landed_responses_are_packed_and_whole(spark):
    rows = accounts(spark, 1050)
    pages, path, root = to_pages(rows, ACCOUNT), new_scratch_path(spark, "packed"), new_scratch_path(spark, "packed-many")
    land_responses(pages, path)
    land_many({"account": pages, "category": pages.limit(0)}, root)
    plain = pages.select(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    for at in (path, f"{root}/entity=account"):
        assert _files(at) and all(f.endswith(".gz") for f in _files(at))
        assert sum(os.path.getsize(f) for f in _files(at)) * 4 < plain
        assert _bag(map_pages(read_pages(spark, at, ACCOUNT), ACCOUNT, "2026-01-01 00:00:00").drop("load_date")) == _bag(rows)
        assert read_responses(spark, at, ACCOUNT).agg(F.max(F.size("results"))).first()[0] <= 100


def test_ids_audit_leaves_no_responses(spark, sf):
    def landed():
        return {f for f in os.listdir(scratch_dir(spark).removeprefix("file:") + "/ledgerlake") if f.startswith("landed-")}
    scratch_dir(spark)
    os.makedirs(scratch_dir(spark).removeprefix("file:") + "/ledgerlake", exist_ok=True)
    before = landed()
    assert Qs.q_ids_audit(spark, sf).select("source_name").distinct().count() == len(ENTITIES)
    assert landed() <= before
