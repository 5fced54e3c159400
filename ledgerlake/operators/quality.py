"""Data tests (Q1-Q10).  Each check returns its violating rows; an empty
result passes.  ``summary`` folds any number of checks into one DataFrame with
one row per check, computed as one Spark job (a union of aggregates).

Scale: ``unique`` is a grouped count with map-side partial aggregation (a hot
key collapses to one partial row per task); ``foreign_key`` is an anti join
whose parent key set is broadcast only when its checked size allows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import maybe_broadcast
from ledgerlake.spec import Check


def unique(df: DataFrame, cols: tuple[str, ...] | list[str]) -> DataFrame:
    """Key values held by more than one row (rows with a null key part are
    skipped).  One column: ``unique_field, n_records``; several: the columns
    and ``n_records``."""
    cols = list(cols)
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    g = df.filter(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
    if len(cols) == 1:
        return g.select(F.col(cols[0]).alias("unique_field"), "n_records")
    return g


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is null."""
    return df.filter(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    """Values outside the allowed list, with their counts (null passes)."""
    c = F.col(col)
    return (df.filter(c.isNotNull() & ~c.isin(list(values)))
              .groupBy(c.alias("value_field")).agg(F.count(F.lit(1)).alias("n_records")))


def primary_key(df: DataFrame, cols) -> DataFrame:
    """Unique + not null: ``key_value, n_records, problem``; all rows with a
    null key part form one ``null`` group.  One grouped count."""
    cols = list(cols)
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in cols]) if len(cols) > 1 else F.col(cols[0]).cast("string")
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    g = (df.select(F.when(any_null, F.lit(None).cast("string")).otherwise(key).alias("key_value"))
           .groupBy("key_value").agg(F.count(F.lit(1)).alias("n_records")))
    problem = F.when(F.col("key_value").isNull(), F.lit("null")).when(F.col("n_records") > 1, F.lit("duplicate"))
    return g.withColumn("problem", problem).filter(F.col("problem").isNotNull())


def foreign_key(child: DataFrame, col: str, parent: DataFrame, parent_col: str,
                broadcast: bool | None = None) -> DataFrame:
    """Child rows whose non-null ``col`` has no parent row."""
    keys = parent.select(F.col(parent_col).alias("__pk")).filter(F.col("__pk").isNotNull()).distinct()
    keys, _ = maybe_broadcast(keys, broadcast)
    return child.filter(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("__pk"), "left_anti")


def expression(df: DataFrame, condition: str) -> DataFrame:
    """Rows matching a SQL predicate (a singular test)."""
    return df.filter(F.expr(condition))


def failures(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """The violating rows of one check."""
    df = tables[check.table]
    if check.kind == "unique":
        return unique(df, check.columns)
    if check.kind == "not_null":
        return not_null(df, check.columns[0])
    if check.kind == "accepted_values":
        return accepted_values(df, check.columns[0], check.values)
    if check.kind == "primary_key":
        return primary_key(df, check.columns)
    if check.kind == "foreign_key":
        return foreign_key(df, check.columns[0], tables[check.parent], check.parent_columns[0])
    if check.kind == "expression":
        return expression(df, check.condition)
    raise ValueError(f"unknown check kind {check.kind!r}")


def orphans(child: DataFrame, checks: list[Check], tables: dict[str, DataFrame], rows: dict[str, int | None]) -> DataFrame:
    """One row with the orphans of each foreign key of a table (``c0``, ``c1``, ...).  The table is scanned once: its
    keys become (check, key) rows, which are counted before any join, so that hot and repeated keys shrink to a row a
    task; null keys go; and one narrow anti join with all parents' keys is left."""
    own = F.array(*[F.struct(F.lit(i).alias("check"), F.col(c.columns[0]).cast("string").alias("key")) for i, c in enumerate(checks)])
    used = (child.select(F.inline(own)).filter(F.col("key").isNotNull())
            .groupBy("check", "key").agg(F.count(F.lit(1)).alias("n")))
    keys = reduce(DataFrame.unionByName, [
        tables[c.parent].select(F.lit(i).alias("check"), F.col(c.parent_columns[0]).cast("string").alias("key")).filter(F.col("key").isNotNull())
        for i, c in enumerate(checks)])
    known = [rows.get(c.parent) for c in checks]
    keys, _ = maybe_broadcast(keys, rows=None if None in known else sum(known))
    lost = used.join(keys, ["check", "key"], "left_anti")
    return lost.agg(*[F.coalesce(F.sum(F.when(F.col("check") == i, F.col("n"))), F.lit(0)).alias(f"c{i}") for i in range(len(checks))])


_ROW_CHECKS = ("not_null", "expression")


def _bad_row(c: Check):
    return F.col(c.columns[0]).isNull() if c.kind == "not_null" else F.expr(c.condition)


def summary(checks: list[Check], tables: dict[str, DataFrame],
            rows: dict[str, int | None] | None = None) -> DataFrame:
    """One row per check: ``test_name, table_name, severity, failures, status``
    (status ``pass``, ``warn`` or ``fail``).

    Row-level checks (not_null, expression) on the same table share one scan:
    a single aggregate of ``count_if`` per check, unpivoted to rows, and so do its
    foreign keys (``orphans``).  Other checks count their own violation rows.  ``rows``: known row counts of the tables (size
    the parent broadcasts without a job).
    """
    def lit_row(c: Check, n: str) -> str:
        return f"'{c.name}', '{c.table}', '{c.severity}', {n}"

    parts = []
    by_table: dict[str, list[Check]] = {}
    fks: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in _ROW_CHECKS:
            by_table.setdefault(c.table, []).append(c)
        elif c.kind == "foreign_key":
            fks.setdefault(c.table, []).append(c)
        else:
            n = failures(c, tables).agg(F.count(F.lit(1)).alias("n"))
            parts.append(n.selectExpr(f"stack(1, {lit_row(c, 'n')}) AS (test_name, table_name, severity, failures)"))

    def stacked(agg: DataFrame, cs: list[Check]) -> DataFrame:
        rows = ", ".join(lit_row(c, f"c{i}") for i, c in enumerate(cs))
        return agg.selectExpr(f"stack({len(cs)}, {rows}) AS (test_name, table_name, severity, failures)")

    for t, cs in by_table.items():
        parts.append(stacked(tables[t].agg(*[F.count_if(_bad_row(c)).alias(f"c{i}") for i, c in enumerate(cs)]), cs))
    for t, cs in fks.items():
        parts.append(stacked(orphans(tables[t], cs, tables, rows or {}), cs))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(
        "test_name", "table_name", "severity", F.col("failures").cast("bigint").alias("failures"),
        F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn")
         .otherwise("fail").alias("status"))


def gate(summary_df: DataFrame) -> list[str]:
    """Names of failed error-severity checks (one small driver-side read of
    the summary, never of data rows).  Empty means the node may be published."""
    return [r["test_name"] for r in summary_df.filter("status = 'fail'").select("test_name").collect()]
