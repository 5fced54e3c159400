"""Raw-layer loading: source filters, incremental read, upsert, hard-delete
sync and date reset (S3, S4, F1, F2, F5, A1, K2-K4, K6).

Pure ``DataFrame -> DataFrame`` functions.  Membership tests are semi/anti
joins, never literal id lists, so a batch of any size stays distributed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import ts_literal
from ledgerlake.operators.joins import maybe_broadcast, shuffled
from ledgerlake.spec import SYSTEM_TIME, EntitySpec


def all_of(preds: list[Column]) -> Column | None:
    """Conjunction of optional predicates; None when there are none (F2)."""
    return reduce(lambda a, b: a & b, preds) if preds else None


def source_filter(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Drop rows the source filter excludes (F1): for each (column, value),
    keep rows where ``column`` is not (null-safe) equal to ``value``; a row
    without a value is kept."""
    pred = all_of([~F.col(c).eqNullSafe(F.lit(v)) for c, v in spec.exclude_equal])
    return df if pred is None else df.filter(pred)


def incremental(df: DataFrame, ts_col: str, watermark) -> DataFrame:
    """Rows edited strictly after ``watermark``; all rows when it is None (S3).

    A literal comparison on a stored column, so parquet pushes it down.
    """
    if watermark is None:
        return df
    return df.filter(F.col(ts_col) > ts_literal(str(watermark)))


def watermark(df: DataFrame, col: str = "load_date") -> DataFrame:
    """``max(load_date)``: one row, null when the table is empty (A1)."""
    return df.agg(F.max(col).alias("watermark"))


def watermark_value(df: DataFrame, col: str = "load_date"):
    """The one scalar a job needs on the driver."""
    return watermark(df, col).first()["watermark"]


def upsert(target: DataFrame, batch: DataFrame, key: str = "id",
           broadcast_batch: bool | None = None, batch_rows: int | None = None) -> DataFrame:
    """Replace target rows whose key is in the batch, then append the batch
    (K2).  Duplicate keys inside the batch are all kept; an empty batch leaves
    the target unchanged.  The batch's key set is broadcast only when its size
    is checked to be small (``batch_rows``, when known, bounds it without a job)."""
    ids = batch.select(key).filter(F.col(key).isNotNull()).distinct()
    ids, _ = maybe_broadcast(ids, broadcast_batch, rows=batch_rows)
    kept = target.join(ids, key, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def hard_delete(target: DataFrame, live_ids: DataFrame, key: str = "id",
                live_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split ``target`` into (kept, removed) by membership of its key in the
    live-id set (K3, J6).  An empty live set removes everything; a null key is
    never live, so it is removed.  The live set is about as large as the target,
    so it is shuffled, whatever Spark estimates; repeated ids need not go."""
    lk = live_key or key
    live = shuffled(live_ids.select(F.col(lk).alias("__live")).filter(F.col("__live").isNotNull()))
    cond = F.col(key) == F.col("__live")
    kept = target.join(live, cond, "left_semi")
    removed = target.join(live, cond, "left_anti")
    return kept, removed


NARROW_FIRST_MIN_ROWS = 100_000


class EmptyLiveSet(ValueError):
    """The live-id set is empty: syncing would delete every row."""


def sync_deletes(target: DataFrame, live_ids: DataFrame, key: str = "id",
                 live_key: str | None = None, target_rows: int | None = None,
                 narrow_min_rows: int = NARROW_FIRST_MIN_ROWS, allow_empty: bool = True) -> tuple[DataFrame, int]:
    """Hard-delete sync for a job: the rows to keep, and how many go.

    The keys alone decide (a narrow shuffle): ``deleted`` counts the rows whose
    key is not live or null.  Nothing to delete leaves ``target`` as it is.  On
    large targets (``target_rows`` unknown or >= ``narrow_min_rows``) the
    deleted keys, usually few, are written apart; when they are under the
    broadcast bound the wide rows are scanned, not shuffled.  Otherwise the
    live set is semi-joined.  All ways keep the same rows.

    ``allow_empty=False`` refuses an empty live set, which would delete all.
    """
    lk = live_key or key
    # only whether a key is there counts, so repeated ids need not go
    live = live_ids.select(F.col(lk).alias(key)).filter(F.col(key).isNotNull())
    if not allow_empty and live.isEmpty():
        raise EmptyLiveSet("no live ids; pass allow_empty=True to delete every row")
    gone = target.select(key).join(live, key, "left_anti")
    if target_rows is not None and target_rows < narrow_min_rows:
        deleted = gone.count()
        return (target if deleted == 0 else target.join(live, key, "left_semi")), deleted
    from ledgerlake.session import scratch_dir
    scratch_dir(target.sparkSession)
    counts = gone.groupBy(key).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    r = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys")).first()
    if not r["rows"]:
        return target, 0
    keys, small = maybe_broadcast(counts.select(key).filter(F.col(key).isNotNull()), rows=r["keys"])
    kept = (target.filter(F.col(key).isNotNull()).join(keys, key, "left_anti") if small
            else target.join(live, key, "left_semi"))
    return kept, int(r["rows"])


def latest_per_key(df: DataFrame, key: str, order: list[str], one_per_key: bool = False) -> DataFrame:
    """Rows holding, per key, the greatest ``order`` tuple (ties all kept, so
    true duplicates stay as the upsert keeps them); null keys pass through.
    ``one_per_key`` keeps exactly one row per key instead (the tie is broken
    by the rest of the row, deterministically).

    A grouped max of a struct (partial aggregation: many copies of one key
    collapse map-side), then a null-safe semi join; never a window over a key.
    """
    if one_per_key:
        rest = [c for c in df.columns if c != key and c not in order]
        best = (df.filter(F.col(key).isNotNull()).groupBy(key)
                  .agg(F.max(F.struct(*[F.col(c) for c in [*order, *rest]])).alias("__m"))
                  .select(key, *[F.col(f"__m.{c}").alias(c) for c in [*order, *rest]]))
        return best.select(*df.columns).unionByName(df.filter(F.col(key).isNull()))
    m = (df.filter(F.col(key).isNotNull()).groupBy(key)
           .agg(F.max(F.struct(*[F.col(c) for c in order])).alias("__m"))
           .select(F.col(key).alias("__lk"), *[F.col(f"__m.{c}").alias(f"__lo_{c}") for c in order]))
    cond = F.col(key) == F.col("__lk")
    for c in order:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__lo_{c}"))
    return df.join(m, cond, "left_semi").unionByName(df.filter(F.col(key).isNull()))


def skinny(pages_or_raw: DataFrame, entity: str, key: str = "id", title: str = "title") -> DataFrame:
    """(id, title, source_name) of every live row: the delete audit's input."""
    return pages_or_raw.select(F.col(key).alias("id"), F.col(title).alias("title"),
                               F.lit(entity).alias("source_name"))


def replace_slice(audit: DataFrame, slice_df: DataFrame, source_name: str) -> DataFrame:
    """Audit table with ``source_name``'s rows replaced by ``slice_df`` (K4).
    An empty slice empties that source's rows."""
    others = audit.filter(~F.col("source_name").eqNullSafe(F.lit(source_name)))
    return others.unionByName(slice_df.select(*audit.columns))


def reset_dates(df: DataFrame, ts: str = SYSTEM_TIME,
                cols: tuple[str, ...] = ("created_time", "last_edited_time")) -> DataFrame:
    """Set the created/edited times of every row to ``ts`` (K6)."""
    return df.withColumns({c: ts_literal(ts) for c in cols})
