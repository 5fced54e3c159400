"""Join helpers shared by the operators.

* A side is broadcast only after its row count is checked against a bound
  (``ledgerlake.broadcast.maxRows``); above it the join is a shuffled
  sort-merge join that AQE may still de-skew.  A hint says so: Spark's own
  estimate goes by file sizes and does not see the rows an explode makes.
* In a shuffled LEFT join all null keys hash to one partition.  They can never
  match, so they get a deterministic, never-matching salted key that spreads
  them over all partitions (no second scan of the input, no random values, so a
  retried task sends each row to the same place).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000     # ~100 MB for a dimension's 4 narrow columns
NULL_SALT_PREFIX = "\u0001null:"   # a business key never starts with \x01


def max_broadcast_rows(df: DataFrame) -> int:
    v = df.sparkSession.conf.get("ledgerlake.broadcast.maxRows", None)
    return int(v) if v else DEFAULT_MAX_BROADCAST_ROWS


def has_at_most(df: DataFrame, n: int) -> bool:
    """True when ``df`` has at most ``n`` rows: a distributed count (a limit
    would send up to n+1 rows of every partition to one task); prefer a
    recorded row count (``rows=``) for stored tables."""
    return df.count() <= n


def maybe_broadcast(df: DataFrame, broadcast: bool | None = None,
                    max_rows: int | None = None, rows: int | None = None) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` when asked, or when its size is under the bound.

    ``rows`` is a known row count (a stored table records it when written), so
    no job runs; otherwise the rows are counted.
    """
    if broadcast is None:
        bound = max_rows or max_broadcast_rows(df)
        broadcast = rows <= bound if rows is not None else has_at_most(df, bound)
    return (F.broadcast(df), True) if broadcast else (shuffled(df), False)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a join side that is never sent whole to the driver and every executor."""
    return df.hint("merge")


def spread_null_key(df: DataFrame, key: str, salt_cols: list[str] | None = None) -> Column:
    """Join key for the probe side of a shuffled LEFT join: the key itself, or
    for a null key a salted text that matches nothing."""
    k = F.col(key)
    if not isinstance(df.schema[key].dataType, StringType):
        return k
    cols = salt_cols or [c for c in df.columns if c != key]
    salt = F.xxhash64(*[F.col(c) for c in cols]) if cols else F.lit(0)
    return F.when(k.isNull(), F.concat(F.lit(NULL_SALT_PREFIX), salt.cast("string"))).otherwise(k)


def left_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                columns: dict[str, Column], broadcast: bool | None = None,
                right_rows: int | None = None) -> DataFrame:
    """``left LEFT JOIN right ON right_key = left_key``, adding ``columns``
    (expressions over ``right``'s columns) to every left row."""
    tmp = f"__lk_{right_key}"
    r = right.select(F.col(right_key).alias(tmp), *[e.alias(f"__lv_{n}") for n, e in columns.items()])
    r, is_bc = maybe_broadcast(r, broadcast, rows=right_rows)
    probe = F.col(left_key) if is_bc else spread_null_key(left, left_key)
    out = left.join(r, probe == F.col(tmp), "left")
    out = out.select(*[F.col(c) for c in left.columns],
                     *[F.col(f"__lv_{n}").alias(n) for n in columns])
    return out
