"""Point-in-time (as-of) dimension lookup with a fallback member.

``fact LEFT JOIN dim ON dim.key = fact.key AND dim.valid_from <= d AND
dim.valid_to > d`` (half-open validity, F3), then ``coalesce(dim.dk,
<dk of the system member>)``.  The system member's dk is an uncorrelated
scalar subquery: run once per query, and an error if there is more than one
system version.

Plan: a dimension under the checked broadcast bound is broadcast (hash join
with the range as residual; the fact is not shuffled).  Above it the join is
a sort-merge join on the key with the range as residual; null fact keys get a
never-matching salted key so they do not pile into one partition, and AQE's
skew join splits a hot key on the fact side.

``asof_sorted_join`` serves dimensions that are too large to broadcast and keys
with long histories, where the join above meets every version of a key with
every fact of it.  Versions and facts go through one sorted pass, in which the
last version begun is carried forward, so the work is their sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.joins import NULL_SALT_PREFIX, maybe_broadcast, spread_null_key
from ledgerlake.session import scratch_dir
from ledgerlake.spec import DK, SYSTEM_KEY, VALID_FROM, VALID_TO, DimRef


def unknown_member(dim: DataFrame, dim_key: str) -> Column:
    """dk of the system member, as a scalar subquery (raises on >1 row)."""
    return dim.filter(F.col(dim_key) == F.lit(SYSTEM_KEY)).select(DK).scalar()


def asof_left_join(fact: DataFrame, dim: DataFrame, ref: DimRef, as_of: str,
                   broadcast: bool | None = None, fallback: bool = True,
                   dim_rows: int | None = None) -> DataFrame:
    """Add ``ref.out`` = dk of the ``dim`` version valid at ``fact[as_of]``.
    ``dim_rows``: the dimension's known row count, if stored."""
    p = f"__{ref.out}"
    d = dim.select(F.col(ref.dim_key).alias(f"{p}_k"), F.col(VALID_FROM).alias(f"{p}_vf"),
                   F.col(VALID_TO).alias(f"{p}_vt"), F.col(DK).alias(f"{p}_dk"))
    d, is_bc = maybe_broadcast(d, broadcast, rows=dim_rows)
    at = F.col(as_of).cast("timestamp_ntz")     # a date compares as its midnight
    probe = F.col(ref.fact_key) if is_bc else spread_null_key(fact, ref.fact_key)
    cond = (probe == F.col(f"{p}_k")) & (F.col(f"{p}_vf") <= at) & (F.col(f"{p}_vt") > at)
    joined = fact.join(d, cond, "left")
    dk = F.col(f"{p}_dk")
    if fallback:
        dk = F.coalesce(dk, unknown_member(dim, ref.dim_key))
    return joined.select(*[F.col(c) for c in fact.columns], dk.alias(ref.out))


# Facts and versions of one key that one task takes; more are cut into time slices.
SLICE_ROWS = 1_000_000


def time_slices(facts: DataFrame, versions: DataFrame, slice_rows: int) -> DataFrame:
    """Of each key with more than ``slice_rows`` rows: the times (ascending) at which they are cut, quantiles of its
    facts' and versions' times, and into how many parts the slice from each cut on is dealt (more than one, where so
    many rows are of one instant).  One row for each such key, so at most rows / ``slice_rows`` of them."""
    times = facts.select("k", "t").unionByName(versions.select("k", F.col("vf").alias("t")))
    hot = times.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_rows)
    scratch_dir(facts.sparkSession)
    hot = hot.checkpoint(eager=True)
    most = hot.agg(F.max("n")).first()[0]
    if most is None:
        return hot.select("k", F.array().cast("array<timestamp_ntz>").alias("cuts"), F.array().cast("array<int>").alias("parts"))
    # as many quantiles as any key needs; a key with fewer rows takes every few of them
    n = -(-most // slice_rows)
    own = times.join(maybe_broadcast(hot)[0], "k").select("k", "n", F.unix_micros(F.col("t").cast("timestamp")).alias("m"))
    q = own.groupBy("k").agg(F.percentile_approx("m", [i / n for i in range(1, n)], 10 * n).alias("q"), F.max("n").alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.lit(n * slice_rows) / F.col("n"))).cast("int")
    q = q.select("k", F.filter("q", lambda x, i: (i + 1) % step == 0).alias("q")).withColumn("at", F.array_sort(F.array_distinct("q")))
    return q.select("k", F.transform("at", lambda m: F.timestamp_micros(m).cast("timestamp_ntz")).alias("cuts"),
                    F.transform("at", lambda m: F.size(F.filter("q", lambda x: x == m))).alias("parts")).checkpoint(eager=True)


def slice_at(t: Column) -> Column:
    """The slice of a time: how many cuts lie at or before it (none: slice 0)."""
    return F.coalesce(F.size(F.filter("cuts", lambda c: c <= t)), F.lit(0))


def parts_of(slice_no: Column) -> Column:
    return F.coalesce(F.when(slice_no > 0, F.try_element_at("parts", slice_no)), F.lit(1))


def asof_sorted_join(fact: DataFrame, dim: DataFrame, ref: DimRef, as_of: str, fallback: bool = True,
                     slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows of ``asof_left_join`` by one sorted pass over versions and facts, whatever the number of versions.

    Each key's versions (which do not overlap, as snapshots keep them) and facts are sorted by time, a version
    before the facts of its instant, and the last version begun is carried forward; it counts if it has not ended.
    A key with many rows is cut into time slices, each a group of its own, into which the version that is open at
    the cut is put as well.  Facts of a null key or time match nothing; they are spread over all tasks.
    """
    t = F.col(as_of).cast("timestamp_ntz")
    whole = F.struct(*[F.col(c) for c in fact.columns])
    nowhere = F.concat(F.lit(NULL_SALT_PREFIX), F.xxhash64(*fact.columns).cast("string"))
    key = F.col(ref.fact_key).cast("string")
    f = fact.select(whole.alias("f"), F.when(key.isNull() | t.isNull(), nowhere).otherwise(key).alias("k"), t.alias("t"))
    v = dim.filter(F.col(ref.dim_key).isNotNull() & (F.col(VALID_FROM) < F.col(VALID_TO))).select(
        F.col(ref.dim_key).cast("string").alias("k"), F.col(VALID_FROM).alias("vf"), F.col(VALID_TO).alias("vt"), F.col(DK).alias("dk"))
    cuts, _ = maybe_broadcast(time_slices(f.filter(~F.col("k").startswith(NULL_SALT_PREFIX)), v, slice_rows))

    no_fact, no_version = F.lit(None).cast(f.schema["f"].dataType), F.lit(None).cast("struct<vt:timestamp_ntz,dk:string>")
    facts = f.join(cuts, "k", "left").withColumn("slice", slice_at(F.col("t")))
    facts = facts.withColumn("part", F.pmod(F.xxhash64("f"), parts_of(F.col("slice"))).cast("int"))
    last = slice_at(F.col("vt") - F.expr("interval 1 microsecond"))
    versions = (v.join(cuts, "k", "left").withColumn("slice", F.explode(F.sequence(slice_at(F.col("vf")), last)))
                .withColumn("part", F.explode(F.sequence(F.lit(0), parts_of(F.col("slice")) - 1))))
    rows = (facts.select("k", "slice", "part", "t", F.lit(1).alias("kind"), "f", no_version.alias("v"))
            .unionByName(versions.select("k", "slice", "part", F.col("vf").alias("t"), F.lit(0).alias("kind"), no_fact.alias("f"),
                                         F.struct("vt", "dk").alias("v"))))
    order = Window.partitionBy("k", "slice", "part").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = rows.withColumn("v", F.last("v", ignorenulls=True).over(order)).filter("kind = 1")
    dk = F.when(F.col("v.vt") > F.col("t"), F.col("v.dk"))
    if fallback:
        dk = F.coalesce(dk, unknown_member(dim, ref.dim_key))
    return carried.select("f.*", dk.alias(ref.out))


def date_key_join(fact: DataFrame, dim_date: DataFrame, as_of: str, out: str,
                  fallback: str = SYSTEM_KEY, dim_rows: int | None = None) -> DataFrame:
    """LEFT equi join to the calendar on the date (J5); missing -> ``fallback``.

    The calendar has one row per day of its range; it is broadcast after the
    same row-count check as any dimension (a range built from bad dates could
    be long).
    """
    d, _ = maybe_broadcast(dim_date.filter(F.col("date").isNotNull())
                           .select(F.col("date").alias(f"__{out}_d"), F.col(DK).alias(f"__{out}_dk")),
                           rows=dim_rows)
    joined = fact.join(d, F.col(as_of) == F.col(f"__{out}_d"), "left")
    return joined.select(*[F.col(c) for c in fact.columns],
                         F.coalesce(F.col(f"__{out}_dk"), F.lit(fallback)).alias(out))
