"""Warehouse build steps as DataFrame compositions (no writes).

``stage_all`` -> ``snapshot_all`` -> ``build_facts``.  ``plans.jobs`` runs
the same steps against stored tables, writing each node and gating it with its
data tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlake.operators.facts import build_fact
from ledgerlake.operators.scd2 import scd2_merge
from ledgerlake.operators.staging import stage
from ledgerlake.plans.specs import FACTS, SNAPSHOTS, STAGING
from ledgerlake.spec import RunContext


def stage_one(name: str, raw: dict[str, DataFrame], rows: dict[str, int | None] | None = None) -> DataFrame:
    spec = STAGING[name]
    parent = raw.get(spec.lookup[0]) if spec.lookup else None
    parent_rows = (rows or {}).get(spec.lookup[0]) if spec.lookup else None
    return stage(raw[spec.raw_table], spec, parent, parent_rows=parent_rows)


def stage_all(raw: dict[str, DataFrame], names=None, rows: dict[str, int | None] | None = None) -> dict[str, DataFrame]:
    """``rows``: known row counts of the raw tables (size the lookups' broadcasts)."""
    names = names or [n for n, s in STAGING.items()
                      if s.raw_table in raw and (not s.lookup or s.lookup[0] in raw)]
    return {n: stage_one(n, raw, rows) for n in names}


def snapshot_all(history: dict[str, DataFrame] | None, stg: dict[str, DataFrame],
                 ctx: RunContext, names=None) -> dict[str, DataFrame]:
    names = names or [n for n, s in SNAPSHOTS.items() if s.source in stg]
    history = history or {}
    return {n: scd2_merge(history.get(n), stg[SNAPSHOTS[n].source], SNAPSHOTS[n], ctx) for n in names}


def build_facts(stg: dict[str, DataFrame], dims: dict[str, DataFrame],
                dim_date: DataFrame | None, names=None,
                broadcast: dict[str, bool | None] | None = None,
                dim_rows: dict[str, int | None] | None = None) -> dict[str, DataFrame]:
    names = names or [n for n, f in FACTS.items() if f.source in stg]
    return {n: build_fact(stg[FACTS[n].source], dims, FACTS[n],
                          dim_date if FACTS[n].date_dim_out else None, broadcast, dim_rows)
            for n in names}
