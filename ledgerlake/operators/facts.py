"""Fact tables (D1, D2): attributes of a staging model plus one dimension key
per point-in-time reference, and optionally the calendar key.

Each reference is its own LEFT as-of join; all small dimensions are broadcast,
so the fact is read once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.asof import asof_left_join, date_key_join
from ledgerlake.spec import FactSpec


def build_fact(source: DataFrame, dims: dict[str, DataFrame], spec: FactSpec,
               dim_date: DataFrame | None = None,
               broadcast: dict[str, bool | None] | None = None,
               dim_rows: dict[str, int | None] | None = None) -> DataFrame:
    """Full rebuild of ``spec``'s fact from its staging model.

    ``dims`` maps snapshot table name -> snapshot DataFrame; ``dim_rows`` their
    known row counts (stored tables), which size the broadcasts without a job.
    """
    dim_rows = dim_rows or {}
    key_cols = {r.fact_key for r in spec.dims}
    keep = list(dict.fromkeys([*spec.attributes, spec.as_of, *key_cols]))
    df = source.select(*keep)
    for ref in spec.dims:
        df = asof_left_join(df, dims[ref.dim], ref, spec.as_of,
                            broadcast=(broadcast or {}).get(ref.dim), dim_rows=dim_rows.get(ref.dim))
    if spec.date_dim_out:
        if dim_date is None:
            raise ValueError(f"{spec.name} needs the calendar dimension")
        df = date_key_join(df, dim_date, spec.as_of, spec.date_dim_out, dim_rows=dim_rows.get("dim_date"))
    outs = [r.out for r in spec.dims] + ([spec.date_dim_out] if spec.date_dim_out else [])
    return df.select(*[F.col(c) for c in spec.attributes], *[F.col(c) for c in outs])
