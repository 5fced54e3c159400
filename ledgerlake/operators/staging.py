"""Raw -> staging (G1-G7): rename, cast, cut text, optional parent lookup,
plus the system row that keeps fact keys from being null (U1).

A staging model is a view: the function returns a lazy DataFrame, which
Catalyst inlines into its consumers (columns not used are pruned away).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import money, text, to_date, to_ts
from ledgerlake.operators.joins import left_lookup
from ledgerlake.spec import Cast, StagingSpec

_TYPES = {"text": "string", "date": "date", "timestamp": "timestamp_ntz", "money": "decimal(27,2)"}


def cast_column(c: Cast, src: Column) -> Column:
    if c.kind == "text":
        return text(src, c.length)
    if c.kind == "date":
        return to_date(src)
    if c.kind == "timestamp":
        return to_ts(src)
    if c.kind == "money":
        return money(src)
    raise ValueError(f"unknown cast kind {c.kind!r}")


def system_row(spark: SparkSession, spec: StagingSpec) -> DataFrame:
    """The one system row, typed like the staging columns (date widened to timestamp)."""
    vals = spec.system_row or {}
    cols = []
    for c in spec.columns:
        v = vals.get(c.target)
        cols.append(F.lit(v).cast(_TYPES[c.kind]).alias(c.target))
    return spark.range(1).select(*cols)


def stage(raw: DataFrame, spec: StagingSpec, parent: DataFrame | None = None,
          broadcast_parent: bool | None = None, parent_rows: int | None = None) -> DataFrame:
    """Typed 1:1 view of ``raw`` per ``spec``.

    ``parent`` is the raw parent table for a spec with a lookup (LEFT join on
    the parent's key, so a missing or null parent gives nulls, never drops
    the row).
    """
    df = raw
    lookup_targets: set[str] = set()
    if spec.lookup is not None:
        if parent is None:
            raise ValueError(f"{spec.name} needs its parent table {spec.lookup[0]!r}")
        _, fk, pk, wanted = spec.lookup
        lookup_targets = set(wanted)
        df = left_lookup(
            df, parent, fk, pk,
            {f"__p_{t}": text(F.col(pcol), n) for t, (pcol, n) in wanted.items()},
            broadcast=broadcast_parent, right_rows=parent_rows)
    cols = []
    for c in spec.columns:
        if c.target in lookup_targets:
            cols.append(F.col(f"__p_{c.target}").alias(c.target))
        else:
            cols.append(cast_column(c, F.col(c.source)).alias(c.target))
    out = df.select(*cols)
    if spec.system_row is not None:
        out = out.unionByName(system_row(raw.sparkSession, spec))
    return out
