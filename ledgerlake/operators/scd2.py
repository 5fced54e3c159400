"""SCD2 ``check`` snapshot merge (V1-V8).

``scd2_merge(history, source, spec, ctx)`` returns the next version of the
snapshot table:

* V1/V2  a key with no open version is inserted: ``valid_from = updated_at``,
  ``valid_to = OPEN``, ``dk = md5(key|updated_at)``;
* V3     a key whose check columns differ (null-safe) closes its open version at
  the source row's ``updated_at`` and starts a new one there;
* V4     a key with no difference keeps its open version as is, unchecked
  columns stay frozen;
* V5     an open key missing from the source is closed at the run time;
* V6     closed versions pass through untouched.

``updated_at`` is the run time, or ``last_edited_time`` on an initial load
(V7).

Plan: only the open versions meet the source, in one full outer join on the
key (one shuffle per side).  Each joined row emits up to two versions through
``inline(filter(array(old, new), x -> x is not null))``, so the join runs once.
Closed versions are a plain scan + union, never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import changed_any, scd_key, ts_literal
from ledgerlake.spec import (DK, OPEN_END, UPDATED_AT, VALID_FROM, VALID_TO,
                             RunContext, SnapshotSpec)

INITIAL_UPDATED_AT = "last_edited_time"


def _updated_at(source: DataFrame, ctx: RunContext) -> Column:
    if ctx.is_initial_load:
        return F.col(INITIAL_UPDATED_AT).cast("timestamp_ntz")
    return ts_literal(ctx.run_ts)


def initial_snapshot(source: DataFrame, spec: SnapshotSpec, ctx: RunContext) -> DataFrame:
    """V1: every source row becomes an open version."""
    upd = _updated_at(source, ctx)
    return source.select(
        *[F.col(c) for c in source.columns],
        scd_key(F.col(spec.key), upd).alias(DK),
        upd.alias(UPDATED_AT), upd.alias(VALID_FROM),
        ts_literal(OPEN_END).alias(VALID_TO))


def validate_source(source: DataFrame, key: str) -> None:
    """Guard: the source key must be unique and not null (one aggregate)."""
    r = (source.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
               .agg(F.count_if(F.col(key).isNull()).alias("null_keys"),
                    F.count_if(F.col("n") > 1).alias("dup_keys")).first())
    if r["null_keys"] or r["dup_keys"]:
        raise ValueError(f"snapshot source key {key!r}: {r['null_keys']} null, {r['dup_keys']} duplicated")


def scd2_merge(history: DataFrame | None, source: DataFrame, spec: SnapshotSpec,
               ctx: RunContext, validate: bool = False, strategy: str = "auto") -> DataFrame:
    """Next snapshot version.  ``history`` None means first run.

    ``validate`` runs the key guard first (the build's unique/not-null tests
    on the staging model do the same job before a snapshot runs).  An initial
    load onto existing history is refused: it would close versions before
    they begin.
    """
    if validate:
        validate_source(source, spec.key)
    if history is None:
        return initial_snapshot(source, spec, ctx)
    hist_cols = _hist_cols(history, source, spec)
    closed = history.filter(F.col(VALID_TO) != ts_literal(OPEN_END)).select(*hist_cols)
    return closed.unionByName(scd2_changes(history, source, spec, ctx, strategy=strategy))


def _hist_cols(history: DataFrame, source: DataFrame, spec: SnapshotSpec) -> list[str]:
    hist_cols = list(source.columns) + [DK, UPDATED_AT, VALID_FROM, VALID_TO]
    missing = [c for c in hist_cols if c not in history.columns]
    if missing:
        raise ValueError(f"history of {spec.name} lacks columns {missing}")
    return hist_cols


NARROW_FIRST_MIN_ROWS = 5_000_000


def scd2_changes(history: DataFrame, source: DataFrame, spec: SnapshotSpec, ctx: RunContext,
                 strategy: str = "auto", history_rows: int | None = None,
                 narrow_min_rows: int = NARROW_FIRST_MIN_ROWS) -> DataFrame:
    """The open versions after this run plus the versions this run closes.

    Reads only the open versions of ``history`` (pass just those when the
    storage keeps them apart); closed versions are not touched.

    ``strategy``: ``wide`` = one full outer join of the open versions with the
    source; ``narrow`` = find the affected keys from the check columns first (see
    ``_changes_narrow``); ``auto`` = narrow when the open history is large
    (``history_rows`` unknown or >= ``narrow_min_rows``).
    """
    if ctx.is_initial_load:
        raise ValueError(f"initial load of {spec.name} onto existing history")
    if strategy == "narrow" or (strategy == "auto" and (history_rows is None or history_rows >= narrow_min_rows)):
        out = _changes_narrow(history, source, spec, ctx)
        if out is not None:
            return out
    return _changes_wide(history, source, spec, ctx)


def _changes_narrow(history: DataFrame, source: DataFrame, spec: SnapshotSpec,
                    ctx: RunContext) -> DataFrame | None:
    """Narrow first: a full outer join of the keys and check columns, compared
    as in the wide join, finds the new, changed and deleted keys (a narrow shuffle); that key set is
    checkpointed and, when under the broadcast bound, broadcast, so unchanged
    open versions pass through without being shuffled and only affected rows
    are rewritten.  Returns None when the key set is too large to broadcast
    (the wide join is then the cheaper plan)."""
    from ledgerlake.operators.joins import max_broadcast_rows
    from ledgerlake.session import scratch_dir
    k = spec.key
    hist_cols = _hist_cols(history, source, spec)
    data_cols = list(source.columns)
    open_end = ts_literal(OPEN_END)
    opened = history.filter(F.col(VALID_TO) == open_end).select(*hist_cols)
    # null keys match nothing in either path: they go before the shuffle
    h = opened.filter(F.col(k).isNotNull()).select(F.col(k).alias("__k"), F.struct(*spec.check_cols).alias("__h"))
    s = source.filter(F.col(k).isNotNull()).select(F.col(k).alias("__k"), F.struct(*spec.check_cols).alias("__s"))
    differ = changed_any([(F.col(f"__h.{c}"), F.col(f"__s.{c}")) for c in spec.check_cols])
    kind = (F.when(F.col("__h").isNull(), F.lit("new"))
             .when(F.col("__s").isNull(), F.lit("deleted"))
             .when(differ, F.lit("changed")))
    spark = source.sparkSession
    scratch_dir(spark)
    affected = (h.join(s, "__k", "full_outer").select("__k", kind.alias("__kind"))
                 .filter(F.col("__kind").isNotNull()).distinct().checkpoint(eager=True))
    if affected.count() > max_broadcast_rows(affected):
        return None
    aff = F.broadcast(affected)
    upd = ts_literal(ctx.run_ts)
    # null keys behave as in the wide join: neither an open version nor a
    # source row with a null key is carried into the result
    unaffected = opened.filter(F.col(k).isNotNull()).join(aff, F.col(k) == F.col("__k"), "left_anti")
    closed_now = (opened.join(aff.filter(F.col("__kind") != "new"), F.col(k) == F.col("__k"), "inner")
                  .withColumn(VALID_TO, upd)          # changed: the new version's updated_at; deleted: run time
                  .select(*hist_cols))
    new_keys = aff.filter(F.col("__kind") != "deleted")
    new = (source.join(new_keys, F.col(k) == F.col("__k"), "left_semi")
           .select(*[F.col(c) for c in data_cols], scd_key(F.col(k), upd).alias(DK), upd.alias(UPDATED_AT),
                   upd.alias(VALID_FROM), open_end.alias(VALID_TO)))
    return unaffected.unionByName(closed_now).unionByName(new)


def _changes_wide(history: DataFrame, source: DataFrame, spec: SnapshotSpec, ctx: RunContext) -> DataFrame:
    data_cols = list(source.columns)
    hist_cols = _hist_cols(history, source, spec)
    open_end = ts_literal(OPEN_END)
    opened = history.filter(F.col(VALID_TO) == open_end).select(*hist_cols)

    h = opened.select(*[F.col(c).alias(f"h_{c}") for c in hist_cols])
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in data_cols],
                      _updated_at(source, ctx).alias("s__upd"))
    hk, sk = F.col(f"h_{spec.key}"), F.col(f"s_{spec.key}")
    j = h.filter(hk.isNotNull()).join(s.filter(sk.isNotNull()), hk == sk, "full_outer")

    both = hk.isNotNull() & sk.isNotNull()
    changed = both & changed_any([(F.col(f"h_{c}"), F.col(f"s_{c}")) for c in spec.check_cols])
    deleted = hk.isNotNull() & sk.isNull()
    inserted = sk.isNotNull() & (hk.isNull() | changed)
    upd = F.col("s__upd")

    old_valid_to = (F.when(deleted, ts_literal(ctx.run_ts))
                     .when(changed, upd)
                     .otherwise(F.col(f"h_{VALID_TO}")))
    old = F.when(hk.isNotNull(), F.struct(
        *[F.col(f"h_{c}").alias(c) for c in data_cols],
        F.col(f"h_{DK}").alias(DK), F.col(f"h_{UPDATED_AT}").alias(UPDATED_AT),
        F.col(f"h_{VALID_FROM}").alias(VALID_FROM), old_valid_to.alias(VALID_TO)))
    new = F.when(inserted, F.struct(
        *[F.col(f"s_{c}").alias(c) for c in data_cols],
        scd_key(sk, upd).alias(DK), upd.alias(UPDATED_AT), upd.alias(VALID_FROM),
        open_end.alias(VALID_TO)))

    return j.select(F.inline(F.filter(F.array(old, new), lambda x: x.isNotNull())))


def open_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col(VALID_TO) == ts_literal(OPEN_END))
