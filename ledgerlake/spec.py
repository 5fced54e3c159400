"""Declarative specs.  Plain dataclasses, no Spark.

One operator serves every entity; what differs between entities (columns,
keys, check columns, references) lives in these specs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values of the warehouse model.
SYSTEM_KEY = "-1"                          # business key of the "unknown" member
SYSTEM_TIME = "1990-01-01 00:00:00"        # created/edited time of the system row; date reset value
OPEN_END = "9999-12-31 00:00:00"           # scd2_valid_to of the current version
RUN_ID_MISSING = 99999999999999            # run id when none is given
RUN_ID_ZONE = "Europe/Sofia"               # zone in which a run id is written

# Bookkeeping columns of a snapshot table.
DK = "dk"
UPDATED_AT = "scd2_updated_at"
VALID_FROM = "scd2_valid_from"
VALID_TO = "scd2_valid_to"
SCD2_COLUMNS = (DK, UPDATED_AT, VALID_FROM, VALID_TO)


@dataclass(frozen=True)
class Prop:
    """One page property mapped to one raw column.

    kind: title | rich_text | select | date | number | relation | checkbox
    """
    name: str            # property name in the document
    column: str          # raw column
    kind: str


@dataclass(frozen=True)
class EntitySpec:
    """How to read, map and load one source entity."""
    name: str                                  # raw table and source_name
    props: tuple[Prop, ...]
    title_prop: str = "Name"                   # property read by the skinny scan
    key: str = "id"
    # optional source filter: tuple of (column, value) pairs that must *not* hold (null-safe)
    exclude_equal: tuple[tuple[str, object], ...] = ()

    @property
    def prop_names(self) -> list[str]:
        return [p.name for p in self.props]


@dataclass(frozen=True)
class Cast:
    """One staging column: ``target = cast(source as kind)``.

    kind: text | date | timestamp | money ; ``length`` cuts text to n chars.
    """
    target: str
    source: str
    kind: str = "text"
    length: int | None = None


@dataclass(frozen=True)
class StagingSpec:
    name: str
    raw_table: str
    columns: tuple[Cast, ...]
    key: str
    # values of the system row; None means no system row
    system_row: dict | None = None
    # LEFT join to a parent raw table: (parent table, child fk column, parent key,
    # {target column: (parent column, text length)})
    lookup: tuple | None = None


@dataclass(frozen=True)
class SnapshotSpec:
    name: str
    source: str                                # staging model
    key: str
    check_cols: tuple[str, ...]
    unique_together: tuple[str, ...] = ()      # e.g. (name, scd2_valid_to)
    not_null: tuple[str, ...] = ()
    entity: str | None = None                  # entity name for run stats

    def entity_name(self) -> str:
        # table name's second '_' part: dim_account -> account
        return self.entity or self.name.split("_")[1]


@dataclass(frozen=True)
class DimRef:
    """A point-in-time reference from a fact to a snapshot dimension."""
    dim: str                # snapshot table
    dim_key: str            # business key column in the dimension
    fact_key: str           # column of the fact holding that key
    out: str                # output column for the dimension's dk


@dataclass(frozen=True)
class FactSpec:
    name: str
    source: str                          # staging model
    attributes: tuple[str, ...]          # columns copied through
    as_of: str                           # date column used for all point-in-time lookups
    dims: tuple[DimRef, ...]
    date_dim_out: str | None = None      # output column for the calendar key, if any
    key: tuple[str, ...] = ()            # business key of the fact


@dataclass(frozen=True)
class Check:
    """A data test.  kind: unique | not_null | accepted_values | foreign_key | expression."""
    name: str
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    parent: str | None = None            # foreign key: parent table
    parent_columns: tuple[str, ...] = ()
    condition: str | None = None         # expression: a SQL predicate that marks bad rows
    severity: str = "error"              # error stops dependants; warn only reports


@dataclass
class RunContext:
    """Values fixed once per run and passed to every step (never the clock)."""
    run_id: int
    run_ts: str                          # 'yyyy-MM-dd HH:mm:ss', UTC
    is_initial_load: bool = False
    dag_name: str = "warehouse_load"
    extra: dict = field(default_factory=dict)
