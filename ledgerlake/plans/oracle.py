"""DuckDB SQL for the correctness check: for each registered query, an
independently written SQL text over the driver's tables (pre-registered as
views).  Built from small SQL pieces (one CTE per raw table, staging model and
snapshot run), so the long chains stay readable.
"""

from __future__ import annotations

from ledgerlake.plans import specs as B
from ledgerlake.sources.testdata import (BATCH1_EDIT, BATCH2_EDIT, BATCH3_EDIT, BATCH_CHANGES,
                                         CHECKED_CHANGE, NEW_KEY_OFFSET, RUN_TS, UNCHECKED_CHANGE)
from ledgerlake.spec import OPEN_END, SYSTEM_TIME

TS = "TIMESTAMP '{}'".format
TYPE_CASE = "CASE WHEN {k} % 2 = 0 THEN 'Приход' ELSE 'Разход' END"


def with_sql(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes.items()) + "\n" + body


# ---------------------------------------------------------------- raw tables
def _dim_times(run=1):
    return (f"{TS(BATCH1_EDIT)} AS created_time, {TS(BATCH1_EDIT)} AS last_edited_time, "
            f"{TS(RUN_TS[run])} AS load_date")


RAW_BASE = {
    "account": f"""SELECT CAST(r_regionkey AS BIGINT) AS _k, CAST(r_regionkey AS VARCHAR) AS id, r_name AS title,
       r_regionkey = 4 AS is_archived, {_dim_times()} FROM region""",
    "category": f"""SELECT CAST(n_nationkey AS BIGINT) AS _k, CAST(n_nationkey AS VARCHAR) AS id, n_name AS title,
       {TYPE_CASE.format(k='n_nationkey')} AS type, n_nationkey % 10 = 9 AS is_archived, {_dim_times()} FROM nation""",
    "subcategory": f"""SELECT c_custkey AS _k, CAST(c_custkey AS VARCHAR) AS id, c_name AS title,
       {TYPE_CASE.format(k='c_custkey')} AS type, CAST(n_regionkey AS VARCHAR) AS account_id,
       CAST(c_nationkey AS VARCHAR) AS category_id, NULLIF(c_mktsegment, 'BUILDING') AS flex_type,
       CASE WHEN c_custkey % 3 = 0 THEN '1998-01-31' END AS due_date, c_custkey % 10 = 0 AS is_archived,
       {_dim_times()}
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "year": f"""SELECT _k, CAST(_k AS VARCHAR) AS id, CAST(_k AS VARCHAR) AS title, {_dim_times()}
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS _k FROM orders)""",
    "month": f"""SELECT _k, CAST(_k AS VARCHAR) AS id, title, {_dim_times()}
FROM (SELECT DISTINCT CAST(month(o_orderdate) AS BIGINT) AS _k, monthname(o_orderdate) AS title FROM orders)""",
    "transaction": f"""SELECT o_orderkey AS _k, CAST(o_orderkey AS VARCHAR) AS id,
       o_orderpriority || ' ' || CAST(o_orderkey AS VARCHAR) AS title, {TYPE_CASE.format(k='o_orderkey')} AS type,
       CASE WHEN o_orderkey % 101 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date,
       CASE WHEN o_orderkey % 37 <> 0 THEN o_totalprice END AS amount,
       CASE o_orderstatus WHEN 'F' THEN 'Платено' WHEN 'P' THEN 'Предстои' ELSE 'В процес' END AS status,
       CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS note,
       CAST(year(o_orderdate) AS VARCHAR) AS year_id, CAST(month(o_orderdate) AS VARCHAR) AS month_id,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            WHEN o_orderkey % 17 = 0 THEN CAST(o_custkey + {NEW_KEY_OFFSET} AS VARCHAR)
            ELSE CAST(o_custkey AS VARCHAR) END AS subcategory_id,
       o_orderkey % 29 = 0 AS is_template,
       o_orderdate AS created_time, o_orderdate AS last_edited_time, {TS(RUN_TS[1])} AS load_date
FROM orders""",
    "budget": f"""SELECT c_custkey * 100 + m AS _k, CAST(c_custkey AS VARCHAR) || '-' || CAST(m AS VARCHAR) AS id,
       c_name || '-' || CAST(m AS VARCHAR) AS title,
       strftime(last_day(make_date(1998, m, 1)), '%Y-%m-%d') AS period_end,
       CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) + m AS DECIMAL(27,2)) AS DOUBLE) AS budget_amount,
       '1998' AS year_id, CAST(m AS VARCHAR) AS month_id, CAST(c_custkey AS VARCHAR) AS subcategory_id,
       c_custkey % 10 = 0 AS is_archived, {_dim_times()}
FROM customer, (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS m)""",
}

RAW_COLUMNS = {
    "account": ["id", "title", "is_archived"],
    "category": ["id", "title", "type", "is_archived"],
    "subcategory": ["id", "title", "type", "account_id", "category_id", "flex_type", "due_date", "is_archived"],
    "year": ["id", "title"],
    "month": ["id", "title"],
    "transaction": ["id", "title", "type", "date", "amount", "status", "note", "year_id", "month_id",
                    "subcategory_id", "is_template"],
    "budget": ["id", "title", "period_end", "budget_amount", "year_id", "month_id", "subcategory_id",
               "is_archived"],
}
RAW_TAIL = ["created_time", "last_edited_time", "load_date"]


def raw_variant_sql(entity: str, base: str, changes, run: int) -> str:
    """Twin of ``testdata.with_changes`` over the CTE ``base``."""
    changes = frozenset(changes)
    cols = RAW_COLUMNS[entity]
    load = f"{TS(RUN_TS[run])} AS load_date"
    if not changes:
        return f"SELECT _k, {', '.join(cols)}, created_time, last_edited_time, {load} FROM {base}"
    touched = ["FALSE"]
    rep = {}
    if "checked" in changes:
        c = CHECKED_CHANGE[entity]
        rep[c] = f"CASE WHEN _k % 5 = 0 THEN {c} || ' *' ELSE {c} END AS {c}"
        touched.append("_k % 5 = 0")
    created = "created_time"
    if "unchecked" in changes:
        created = f"CASE WHEN _k % 7 = 0 THEN {TS(BATCH2_EDIT)} ELSE created_time END AS created_time"
        if entity in UNCHECKED_CHANGE:
            c = UNCHECKED_CHANGE[entity]
            rep[c] = f"CASE WHEN _k % 7 = 0 THEN {c} || ' x' ELSE {c} END AS {c}"
        touched.append("_k % 7 = 0")
    edited = f"CASE WHEN {' OR '.join(touched)} THEN {TS(BATCH2_EDIT)} ELSE last_edited_time END AS last_edited_time"
    sel = ", ".join(["_k"] + [rep.get(c, c) for c in cols] + [created, edited, load])
    where = " WHERE _k % 17 <> 0" if "drop" in changes else ""
    body = f"SELECT {sel} FROM {base}{where}"
    if "add" in changes:
        sel_add = ", ".join(
            [f"_k + {NEW_KEY_OFFSET} AS _k"]
            + [(f"CAST(_k + {NEW_KEY_OFFSET} AS VARCHAR) AS id" if c == "id" else c) for c in cols]
            + [f"{TS(BATCH2_EDIT)} AS created_time", f"{TS(BATCH2_EDIT)} AS last_edited_time", load])
        body += f"\nUNION ALL\nSELECT {sel_add} FROM {base} WHERE _k % 50 = 0"
    if "revive" in changes:
        sel_back = ", ".join(["_k"] + cols + ["created_time", f"{TS(BATCH3_EDIT)} AS last_edited_time", load])
        body += f"\nUNION ALL\nSELECT {sel_back} FROM {base} WHERE _k % 17 = 0"
    return body


def raw_ctes(entity: str, batch: int, prefix: str | None = None) -> dict[str, str]:
    """CTEs ``<prefix>_base`` and ``<prefix>_b1`` .. ``<prefix>_b<batch>``; each keeps ``_k``."""
    p = prefix or f"raw_{entity}"
    ctes = {f"{p}_base": RAW_BASE[entity]}
    for b in range(1, batch + 1):
        ctes[f"{p}_b{b}"] = raw_variant_sql(entity, f"{p}_base", BATCH_CHANGES[b], b)
    return ctes


def raw_select(entity: str, src: str, reset: bool = False, txn_filter: bool = False) -> str:
    cols = RAW_COLUMNS[entity]
    tail = ([f"{TS(SYSTEM_TIME)} AS created_time", f"{TS(SYSTEM_TIME)} AS last_edited_time", "load_date"]
            if reset else RAW_TAIL)
    where = (f" WHERE is_template IS NOT TRUE AND status IS DISTINCT FROM '{B.PLANNED_STATUS}'"
             if txn_filter else "")
    return f"SELECT {', '.join(cols + tail)} FROM {src}{where}"


# ------------------------------------------------------------------ staging
def _cast_sql(c, src: str) -> str:
    if c.kind == "text":
        e = f"CAST({src} AS VARCHAR)"
        return f"left({e}, {c.length})" if c.length else e
    if c.kind == "date":
        return f"CAST({src} AS DATE)"
    if c.kind == "timestamp":
        return f"CAST({src} AS TIMESTAMP)"
    if c.kind == "money":
        return f"CAST({src} AS DECIMAL(27,2))"
    raise ValueError(c.kind)


_SQL_TYPES = {"text": "VARCHAR", "date": "DATE", "timestamp": "TIMESTAMP", "money": "DECIMAL(27,2)"}


def staging_sql(name: str, raw: str, parent: str | None = None) -> str:
    spec = B.STAGING[name]
    sel = []
    lookup = spec.lookup[3] if spec.lookup else {}
    for c in spec.columns:
        if c.target in lookup:
            pcol, n = lookup[c.target]
            sel.append(f"left(CAST(p.{pcol} AS VARCHAR), {n}) AS {c.target}")
        else:
            sel.append(f"{_cast_sql(c, 't.' + c.source)} AS {c.target}")
    sql = f"SELECT {', '.join(sel)}\nFROM {raw} t"
    if spec.lookup:
        _, fk, pk, _ = spec.lookup
        sql += f" LEFT JOIN {parent} p ON p.{pk} = t.{fk}"
    if spec.system_row is not None:
        vals = []
        for c in spec.columns:
            v = spec.system_row.get(c.target)
            lit = "NULL" if v is None else ("'" + str(v) + "'")
            vals.append(f"CAST({lit} AS {_SQL_TYPES[c.kind]}) AS {c.target}")
        sql += "\nUNION ALL\nSELECT " + ", ".join(vals)
    return sql


def staging_columns(name: str) -> list[str]:
    return [c.target for c in B.STAGING[name].columns]


# ------------------------------------------------------------------ snapshots
def _dk(key: str, upd: str) -> str:
    return f"md5(coalesce(CAST({key} AS VARCHAR), '') || '|' || coalesce(CAST({upd} AS VARCHAR), ''))"


def snapshot_initial_sql(snap: str, stg: str, upd: str) -> str:
    spec = B.SNAPSHOTS[snap]
    cols = staging_columns(spec.source)
    return (f"SELECT {', '.join(cols)}, {_dk(spec.key, upd)} AS dk, {upd} AS scd2_updated_at, "
            f"{upd} AS scd2_valid_from, {TS(OPEN_END)} AS scd2_valid_to FROM {stg}")


def snapshot_merge_sql(snap: str, hist: str, stg: str, run_ts: str, upd_col: str | None = None) -> str:
    """One later run: ``upd_col`` is the source column used as updated_at on an
    initial load; otherwise the run time."""
    spec = B.SNAPSHOTS[snap]
    cols = staging_columns(spec.source)
    k = spec.key
    upd = f"s.{upd_col}" if upd_col else TS(run_ts)
    diff = " OR ".join(f"h.{c} IS DISTINCT FROM s.{c}" for c in spec.check_cols)
    open_ = TS(OPEN_END)
    old = (f"SELECT {', '.join('h.' + c for c in cols)}, h.dk, h.scd2_updated_at, h.scd2_valid_from,\n"
           f"  CASE WHEN h.scd2_valid_to <> {open_} THEN h.scd2_valid_to\n"
           f"       WHEN s.{k} IS NULL THEN {TS(run_ts)}\n"
           f"       WHEN {diff} THEN {upd}\n"
           f"       ELSE h.scd2_valid_to END AS scd2_valid_to\n"
           f"FROM {hist} h LEFT JOIN {stg} s ON h.{k} = s.{k} AND h.scd2_valid_to = {open_}")
    new = (f"SELECT {', '.join('s.' + c for c in cols)}, {_dk('s.' + k, upd)} AS dk, {upd} AS scd2_updated_at, "
           f"{upd} AS scd2_valid_from, {open_} AS scd2_valid_to\n"
           f"FROM {stg} s LEFT JOIN (SELECT * FROM {hist} WHERE scd2_valid_to = {open_}) h ON h.{k} = s.{k}\n"
           f"WHERE h.{k} IS NULL OR {diff}")
    return f"{old}\nUNION ALL\n{new}"


# ---------------------------------------------------------------- calendar
def dim_date_sql(src: str, col: str) -> str:
    return f"""SELECT strftime(d, '%Y%m%d') AS dk, d AS date, strftime(d, '%B %-d, %Y') AS full_date_description,
       dayname(d) AS day_of_week, CAST(day(d) AS INTEGER) AS day_number_in_calendar_month,
       CAST(dayofyear(d) AS INTEGER) AS day_number_in_calendar_year,
       CASE WHEN d = last_day(d) THEN 'Yes' ELSE 'No' END AS last_day_in_month_indicator,
       CAST(d + CAST(7 - isodow(d) AS INTEGER) AS DATE) AS calendar_week_ending_date,
       CAST(weekofyear(d) AS INTEGER) AS calendar_week_number_in_year, monthname(d) AS calendar_month_name,
       strftime(d, '%m') AS calendar_month_number_in_year, strftime(d, '%Y-%m') AS "calendar_year-month",
       'Q' || CAST(quarter(d) AS VARCHAR) AS calendar_quarter,
       CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS "calendar_year-quarter",
       CAST(year(d) AS VARCHAR) AS calendar_year, 'Non-Holiday' AS holiday_indicator,
       CASE WHEN isodow(d) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS weekday_indicator
FROM (SELECT CAST(unnest(generate_series(min(CAST({col} AS DATE)), max(CAST({col} AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
      FROM {src})
UNION ALL
SELECT '-1', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL"""


# ------------------------------------------------------------------ facts
def fact_sql(fact: str, stg: str, dims: dict[str, str], dim_date: str | None) -> str:
    spec = B.FACTS[fact]
    sel = [f"t.{a}" for a in spec.attributes]
    joins = []
    for i, r in enumerate(spec.dims):
        a = f"d{i}"
        dim = dims[r.dim]
        sel.append(f"coalesce({a}.dk, (SELECT dk FROM {dim} WHERE {r.dim_key} = '-1')) AS {r.out}")
        joins.append(f"LEFT JOIN {dim} {a} ON {a}.{r.dim_key} = t.{r.fact_key} "
                     f"AND {a}.scd2_valid_from <= t.{spec.as_of} AND {a}.scd2_valid_to > t.{spec.as_of}")
    if spec.date_dim_out:
        sel.append(f"coalesce(dd.dk, '-1') AS {spec.date_dim_out}")
        joins.append(f"LEFT JOIN {dim_date} dd ON dd.date = t.{spec.as_of}")
    return f"SELECT {', '.join(sel)}\nFROM {stg} t\n" + "\n".join(joins)


# ------------------------------------------------------- shared compositions
DIM_ENTITIES = ("account", "category", "subcategory", "year", "month")
ALL = frozenset({"drop", "checked", "unchecked", "add"})
NONE = frozenset()
THREE_RUNS = [(NONE, 1, True), (ALL, 2, False), (ALL | {"revive"}, 3, False)]
TWO_RUNS = THREE_RUNS[:2]


def _tag(run, changes, reset=False):
    return f"r{run}_" + ("_".join(sorted(changes)) or "none") + ("_reset" if reset else "")


def raw_cte(ctes: dict, entity: str, run: int, changes=None, reset: bool = False) -> str:
    """Add the CTEs of one raw table state; returns the name of the typed,
    source-filtered raw CTE (no ``_k``)."""
    changes = BATCH_CHANGES[run] if changes is None else frozenset(changes)
    base = f"raw_{entity}_base"
    ctes.setdefault(base, RAW_BASE[entity])
    var = f"raw_{entity}_{_tag(run, changes)}"
    ctes.setdefault(var, raw_variant_sql(entity, base, changes, run))
    name = f"{var}_sel" + ("_reset" if reset else "")
    ctes.setdefault(name, raw_select(entity, var, reset=reset, txn_filter=(entity == "transaction")))
    return name


def staged_cte(ctes: dict, name: str, run: int = 1, reset: bool = False, changes=None,
               parent_run: int | None = None) -> str:
    spec = B.STAGING[name]
    raw = raw_cte(ctes, spec.raw_table, run, changes, reset)
    parent = None
    if spec.lookup:
        parent = raw_cte(ctes, spec.lookup[0], parent_run or run, None if parent_run else changes, reset)
    cte = f"{name}_{_tag(run, BATCH_CHANGES[run] if changes is None else changes, reset)}" + (
        f"_p{parent_run}" if parent_run else "")
    ctes.setdefault(cte, staging_sql(name, raw, parent))
    return cte


def snapshot_runs_cte(ctes: dict, snap: str, runs) -> str:
    spec = B.SNAPSHOTS[snap]
    hist = None
    tags = []
    for changes, run, initial in runs:
        stg = staged_cte(ctes, spec.source, run, reset=initial, changes=changes)
        tags.append(_tag(run, changes, initial))
        name = f"{snap}__" + "__".join(tags)
        if hist is None:
            upd = "last_edited_time" if initial else TS(RUN_TS[run])
            ctes.setdefault(name, snapshot_initial_sql(snap, stg, upd))
        else:
            ctes.setdefault(name, snapshot_merge_sql(snap, hist, stg, RUN_TS[run],
                                                     "last_edited_time" if initial else None))
        hist = name
    return hist


def _generic_select(src: str, entity: str, cols: list[str]) -> str:
    return (f"SELECT '{entity}' AS entity, "
            + ", ".join(f"{c} AS {c.replace(entity + '_', '')}" for c in cols) + f" FROM {src}")


SNAP_COLS = ["dk", "scd2_updated_at", "scd2_valid_from", "scd2_valid_to"]


# ------------------------------------------------------------ query oracles
def o_stg(name):
    def o():
        ctes = {}
        return with_sql(ctes, f"SELECT * FROM {staged_cte(ctes, name)}")
    return o


def o_stg_year_month():
    ctes = {}
    y, m = staged_cte(ctes, "stg_year"), staged_cte(ctes, "stg_month")
    return with_sql(ctes, _generic_select(y, "year", staging_columns("stg_year")) + "\nUNION ALL\n"
                    + _generic_select(m, "month", staging_columns("stg_month")))


SCD2_CASES = {
    "scd2_initial": [(NONE, 1, False)],
    "scd2_new": [(NONE, 1, False), (frozenset({"add"}), 2, False)],
    "scd2_changed": [(NONE, 1, False), (frozenset({"checked"}), 2, False)],
    "scd2_unchecked_frozen": [(NONE, 1, False), (frozenset({"unchecked"}), 2, False)],
    "scd2_hard_delete": [(NONE, 1, False), (frozenset({"drop"}), 2, False)],
    "scd2_revived": [(NONE, 1, False), (frozenset({"drop"}), 2, False), (frozenset({"drop", "revive"}), 3, False)],
    "scd2_two_batches": [(NONE, 1, False), (ALL, 2, False), (ALL | {"revive"}, 3, False)],
    "scd2_initial_load_dates": [(NONE, 1, True), (ALL, 2, False)],
}


def o_scd2_case(case):
    def o():
        ctes = {}
        return with_sql(ctes, f"SELECT * FROM {snapshot_runs_cte(ctes, 'dim_subcategory', SCD2_CASES[case])}")
    return o


def o_scd2_spec(snap):
    def o():
        ctes = {}
        return with_sql(ctes, f"SELECT * FROM {snapshot_runs_cte(ctes, snap, THREE_RUNS)}")
    return o


def o_scd2_dim_year_month():
    ctes = {}
    y = snapshot_runs_cte(ctes, "dim_year", THREE_RUNS)
    m = snapshot_runs_cte(ctes, "dim_month", THREE_RUNS)
    return with_sql(ctes, _generic_select(y, "year", staging_columns("stg_year") + SNAP_COLS) + "\nUNION ALL\n"
                    + _generic_select(m, "month", staging_columns("stg_month") + SNAP_COLS))


def dims_two_runs(ctes: dict, entities=DIM_ENTITIES) -> dict[str, str]:
    return {f"dim_{e}": snapshot_runs_cte(ctes, f"dim_{e}", TWO_RUNS) for e in entities}


def o_fact_transaction() -> str:
    ctes = {}
    dims = dims_two_runs(ctes)
    stg = staged_cte(ctes, "stg_transaction", 1, parent_run=2)
    ctes["dim_date"] = dim_date_sql(stg, "transaction_date")
    return with_sql(ctes, fact_sql("fact_transaction", stg, dims, "dim_date"))


def o_fact_budget() -> str:
    ctes = {}
    dims = dims_two_runs(ctes, ("category", "subcategory", "year", "month"))
    stg = staged_cte(ctes, "stg_budget", 1, parent_run=2)
    return with_sql(ctes, fact_sql("fact_budget", stg, dims, None))


def _asof_sql(fact_sel: str, dim: str, key: str, at: str, out: str) -> str:
    return (f"SELECT f.*, coalesce(d.dk, (SELECT dk FROM {dim} WHERE subcategory_id_bk = '-1')) AS {out}\n"
            f"FROM ({fact_sel}) f LEFT JOIN {dim} d ON d.subcategory_id_bk = f.{key} "
            f"AND d.scd2_valid_from <= f.{at} AND d.scd2_valid_to > f.{at}")


def o_asof_single() -> str:
    ctes = {}
    dim = snapshot_runs_cte(ctes, "dim_subcategory", TWO_RUNS)
    stg = staged_cte(ctes, "stg_transaction", 1, parent_run=2)
    return with_sql(ctes, _asof_sql(f"SELECT transaction_id_bk, transaction_date, subcategory_id FROM {stg}",
                                    dim, "subcategory_id", "transaction_date", "subcategory_dk"))


BOUNDARY_DATES = ("1989-12-31", "1990-01-01", "1998-05-31", "1998-06-01", "1999-12-31", "2000-01-01",
                  "2000-01-02", None)


def o_asof_boundary() -> str:
    ctes = {}
    dim = snapshot_runs_cte(ctes, "dim_subcategory", THREE_RUNS)
    keys = staged_cte(ctes, "stg_subcategory", 3, changes=ALL | {"revive"})
    dates = ", ".join("NULL" if d is None else f"DATE '{d}'" for d in BOUNDARY_DATES)
    probes = (f"SELECT subcategory_id_bk AS subcategory_id, CAST(unnest([{dates}]) AS DATE) AS probe_date "
              f"FROM {keys}")
    return with_sql(ctes, _asof_sql(probes, dim, "subcategory_id", "probe_date", "subcategory_dk"))


def o_unknown_member() -> str:
    ctes = {}
    dims = dims_two_runs(ctes)
    parts = [f"SELECT '{n}' AS dim, (SELECT dk FROM {c} WHERE {n[4:]}_id_bk = '-1') AS unknown_dk"
             for n, c in dims.items()]
    return with_sql(ctes, "\nUNION ALL\n".join(parts))


def o_dim_date() -> str:
    return dim_date_sql("orders", "o_orderdate")


# --------------------------------------------------------------------- load
ENTITY_NAMES = tuple(e.name for e in B.ENTITY_ORDER)


def load_runs_cte(ctes: dict, entity: str, changes2=None, src2: str | None = None, tag: str = "") -> dict:
    """Two entity loads on the raw layer; returns CTE names per step."""
    p = f"load_{entity}{tag}"
    src1 = raw_cte(ctes, entity, 1)
    ctes[f"{p}_kept1"] = (f"SELECT * FROM {src1} u WHERE EXISTS "
                          f"(SELECT 1 FROM {src1} s WHERE s.id = u.id)")
    src2 = src2 or raw_cte(ctes, entity, 2, changes2)
    ctes[f"{p}_incr2"] = (f"SELECT * FROM {src2} WHERE last_edited_time > "
                          f"(SELECT max(load_date) FROM {p}_kept1)")
    ctes[f"{p}_ups2"] = (f"SELECT * FROM {p}_kept1 t WHERE NOT EXISTS (SELECT 1 FROM {p}_incr2 b WHERE b.id = t.id)"
                         f"\nUNION ALL\nSELECT * FROM {p}_incr2")
    ctes[f"{p}_kept2"] = f"SELECT * FROM {p}_ups2 u WHERE EXISTS (SELECT 1 FROM {src2} s WHERE s.id = u.id)"
    ctes[f"{p}_removed2"] = f"SELECT * FROM {p}_ups2 u WHERE NOT EXISTS (SELECT 1 FROM {src2} s WHERE s.id = u.id)"
    return {"src1": src1, "kept1": f"{p}_kept1", "src2": src2, "incr2": f"{p}_incr2", "ups2": f"{p}_ups2",
            "kept2": f"{p}_kept2", "removed2": f"{p}_removed2"}


def _sel(body_cte: str) -> str:
    return f"SELECT * FROM {body_cte}"


def o_watermark() -> str:
    ctes = {}
    parts = [f"SELECT '{e}' AS entity, max(load_date) AS watermark FROM {load_runs_cte(ctes, e)['kept1']}"
             for e in ENTITY_NAMES]
    return with_sql(ctes, "\nUNION ALL\n".join(parts))


def o_load_step(entity: str, step: str, changes2=None):
    def o():
        ctes = {}
        return with_sql(ctes, _sel(load_runs_cte(ctes, entity, changes2)[step]))
    return o


def o_incremental_full() -> str:
    ctes = {}
    return with_sql(ctes, _sel(raw_cte(ctes, "subcategory", 2)))


def o_txn_source_filter() -> str:
    ctes = {}
    return with_sql(ctes, _sel(raw_cte(ctes, "transaction", 1)))


def o_txn_turned_planned() -> str:
    ctes = {"raw_transaction_base": RAW_BASE["transaction"]}
    ctes["raw_transaction_r2_none"] = raw_variant_sql("transaction", "raw_transaction_base", NONE, 2)
    cols = [(f"CASE WHEN _k % 11 = 0 THEN '{B.PLANNED_STATUS}' ELSE status END AS status" if c == "status" else c)
            for c in RAW_COLUMNS["transaction"]] + RAW_TAIL
    ctes["planned_all"] = f"SELECT {', '.join(cols)} FROM raw_transaction_r2_none"
    ctes["planned_src"] = (f"SELECT * FROM planned_all WHERE is_template IS NOT TRUE "
                           f"AND status IS DISTINCT FROM '{B.PLANNED_STATUS}'")
    return with_sql(ctes, _sel(load_runs_cte(ctes, "transaction", src2="planned_src", tag="_planned")["removed2"]))


def o_reset_dates() -> str:
    ctes = {}
    raw = raw_cte(ctes, "transaction", 1)
    return with_sql(ctes, raw_select("transaction", raw, reset=True))


# ------------------------------------------------------------------- scalar
def o_cast_text() -> str:
    return """SELECT c_custkey, left(CAST(c_name AS VARCHAR), 12) AS name_12, left(c_mktsegment, 5) AS segment_5,
       left(CAST(c_nationkey AS VARCHAR), 1) AS nation_1, c_name AS name_full,
       CAST(c_custkey % 2 = 0 AS VARCHAR) AS is_even
FROM customer"""


def o_cast_decimal() -> str:
    return """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(27,2)) AS amount,
       CAST(CAST(o_totalprice AS DECIMAL(27,2)) * 3 - CAST(o_totalprice AS DECIMAL(27,2)) AS DECIMAL(27,2)) AS amount_expr
FROM orders"""


_ISO = ("strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') "
        "|| (['Z', '+02:00', '-05:30'])[CAST(o_orderkey % 3 AS INTEGER) + 1]")


def o_cast_temporal() -> str:
    return f"""SELECT o_orderkey, iso_text, timezone('UTC', CAST(iso_text AS TIMESTAMPTZ)) AS as_timestamp,
       CAST(left(iso_text, 10) AS DATE) AS as_date
FROM (SELECT o_orderkey, {_ISO} AS iso_text FROM orders)"""


def o_run_id_format() -> str:
    return """SELECT o_orderkey, raw_run_id,
       CASE WHEN raw_run_id IS NULL THEN 99999999999999
            WHEN contains(raw_run_id, 'T')
              THEN CAST(strftime(timezone('Europe/Sofia', CAST(raw_run_id AS TIMESTAMPTZ)), '%Y%m%d%H%M%S') AS BIGINT)
            ELSE CAST(raw_run_id AS BIGINT) END AS run_id
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 11 = 0 THEN NULL
                  WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey + 20000000000000 AS VARCHAR)
                  ELSE strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ')
             END AS raw_run_id
      FROM orders)"""


# ------------------------------------------------------------------ quality
def _appended_subcategory(ctes: dict) -> str:
    a, b = raw_cte(ctes, "subcategory", 1), raw_cte(ctes, "subcategory", 2)
    ctes["raw_subcategory_appended"] = f"SELECT * FROM {a}\nUNION ALL\nSELECT * FROM {b}"
    return "raw_subcategory_appended"


def _sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def check_failures_sql(c, tables: dict[str, str]) -> str:
    """Violating rows of one check, in the same shape as ``operators.quality``."""
    t = tables[c.table]
    if c.kind == "unique":
        cols = list(c.columns)
        nn = " AND ".join(f"{x} IS NOT NULL" for x in cols)
        if len(cols) == 1:
            return (f"SELECT {cols[0]} AS unique_field, count(*) AS n_records FROM {t} WHERE {nn} "
                    f"GROUP BY {cols[0]} HAVING count(*) > 1")
        return (f"SELECT {', '.join(cols)}, count(*) AS n_records FROM {t} WHERE {nn} "
                f"GROUP BY {', '.join(cols)} HAVING count(*) > 1")
    if c.kind == "not_null":
        return f"SELECT * FROM {t} WHERE {c.columns[0]} IS NULL"
    if c.kind == "accepted_values":
        col = c.columns[0]
        return (f"SELECT {col} AS value_field, count(*) AS n_records FROM {t} WHERE {col} IS NOT NULL "
                f"AND {col} NOT IN ({_sql_list(c.values)}) GROUP BY {col}")
    if c.kind == "primary_key":
        cols = list(c.columns)
        key = " || '|' || ".join(f"CAST({x} AS VARCHAR)" for x in cols)
        anynull = " OR ".join(f"{x} IS NULL" for x in cols)
        return (f"SELECT {key} AS key_value, count(*) AS n_records, 'duplicate' AS problem FROM {t} "
                f"WHERE NOT ({anynull}) GROUP BY {key} HAVING count(*) > 1\nUNION ALL\n"
                f"SELECT NULL, count(*), 'null' FROM {t} WHERE {anynull} HAVING count(*) > 0")
    if c.kind == "foreign_key":
        col, pt, pc = c.columns[0], tables[c.parent], c.parent_columns[0]
        return (f"SELECT * FROM {t} f WHERE f.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {pt} p WHERE p.{pc} = f.{col})")
    if c.kind == "expression":
        return f"SELECT * FROM {t} WHERE {c.condition}"
    raise ValueError(c.kind)


def o_dq_unique() -> str:
    ctes = {}
    raw = _appended_subcategory(ctes)
    ctes["stg_subcategory_dup"] = staging_sql("stg_subcategory", raw)
    return with_sql(ctes, "SELECT subcategory_id_bk AS unique_field, count(*) AS n_records FROM stg_subcategory_dup "
                          "WHERE subcategory_id_bk IS NOT NULL GROUP BY 1 HAVING count(*) > 1")


def o_dq_unique_composite() -> str:
    ctes = {}
    d = snapshot_runs_cte(ctes, "dim_subcategory", SCD2_CASES["scd2_new"])
    return with_sql(ctes, f"SELECT subcategory_name, scd2_valid_to, count(*) AS n_records FROM {d} "
                          "WHERE subcategory_name IS NOT NULL AND scd2_valid_to IS NOT NULL "
                          "GROUP BY subcategory_name, scd2_valid_to HAVING count(*) > 1")


def o_dq_not_null() -> str:
    ctes = {}
    stg = staged_cte(ctes, "stg_transaction")
    parts = [f"SELECT '{c.name}' AS test_name, transaction_id_bk AS key_value FROM {stg} WHERE {c.columns[0]} IS NULL"
             for c in B.STAGING_CHECKS if c.kind == "not_null" and c.table == "stg_transaction"]
    return with_sql(ctes, "\nUNION ALL\n".join(parts))


def _staging_batch2(ctes: dict) -> dict[str, str]:
    return {n: staged_cte(ctes, n, 2) for n in B.STAGING}


def o_dq_accepted_values() -> str:
    ctes = {}
    stg = _staging_batch2(ctes)
    parts = [f"SELECT '{c.name}' AS test_name, value_field, n_records FROM ({check_failures_sql(c, stg)})"
             for c in B.STAGING_CHECKS if c.kind == "accepted_values"]
    return with_sql(ctes, "\nUNION ALL\n".join(parts))


def o_dq_primary_key() -> str:
    ctes = {}
    raw_sub = _appended_subcategory(ctes)
    raw_txn = raw_cte(ctes, "transaction", 1)
    ctes["stg_transaction_dup"] = staging_sql("stg_transaction", raw_txn, raw_sub)
    chk = B.Check("pk", "stg_transaction_dup", "primary_key", ("transaction_id_bk",))
    return with_sql(ctes, check_failures_sql(chk, {"stg_transaction_dup": "stg_transaction_dup"}))


def _fact_transaction_ctes(ctes: dict) -> str:
    dims = dims_two_runs(ctes)
    stg = staged_cte(ctes, "stg_transaction", 1, parent_run=2)
    ctes["dim_date"] = dim_date_sql(stg, "transaction_date")
    ctes["fact_transaction"] = fact_sql("fact_transaction", stg, dims, "dim_date")
    return "fact_transaction"


def o_dq_foreign_key() -> str:
    ctes = {}
    fact = _fact_transaction_ctes(ctes)
    tables = {"fact_transaction": fact, "dim_date": "dim_date"}
    for e in DIM_ENTITIES:
        tables[f"dim_{e}"] = snapshot_runs_cte(ctes, f"dim_{e}", TWO_RUNS[:1])
    parts = []
    for c in B.WAREHOUSE_CHECKS:
        if c.kind == "foreign_key" and c.table == "fact_transaction":
            parts.append(f"SELECT '{c.name}' AS test_name, {c.columns[0]} AS child_value, count(*) AS n_records "
                         f"FROM ({check_failures_sql(c, tables)}) GROUP BY {c.columns[0]}")
    return with_sql(ctes, "\nUNION ALL\n".join(parts))


def o_dq_singular_warn() -> str:
    ctes = {}
    fact = _fact_transaction_ctes(ctes)
    chk = next(c for c in B.WAREHOUSE_CHECKS if c.name == "transaction_amount_is_null")
    return with_sql(ctes, f"SELECT * FROM {fact} WHERE {chk.condition}")


def summary_sql(checks, tables: dict[str, str]) -> str:
    parts = []
    for c in checks:
        parts.append(
            f"SELECT '{c.name}' AS test_name, '{c.table}' AS table_name, '{c.severity}' AS severity, failures, "
            f"CASE WHEN failures = 0 THEN 'pass' WHEN '{c.severity}' = 'warn' THEN 'warn' ELSE 'fail' END AS status "
            f"FROM (SELECT count(*) AS failures FROM ({check_failures_sql(c, tables)}))")
    return "\nUNION ALL\n".join(parts)


def o_dq_summary() -> str:
    ctes = {}
    stg = _staging_batch2(ctes)
    return with_sql(ctes, summary_sql(B.STAGING_CHECKS, stg))


# -------------------------------------------------------------------- stats
def _run_id(run: int) -> int:
    return int(RUN_TS[run].replace("-", "").replace(":", "").replace(" ", ""))


DAG = "warehouse_load"


def _load_counts_ctes(ctes: dict) -> str:
    parts = []
    for e in ENTITY_NAMES:
        n = load_runs_cte(ctes, e)
        for run, incr, removed in ((1, n["src1"], None), (2, n["incr2"], n["removed2"])):
            dele = f"(SELECT count(*) FROM {removed})" if removed else "0"
            parts.append(f"SELECT CAST({_run_id(run)} AS BIGINT) AS run_id, DATE '{RUN_TS[run][:10]}' AS run_date, "
                         f"'{DAG}' AS dag_name, 'extract_and_load_{e}' AS task_name, "
                         f"(SELECT count(*) FROM {incr}) AS ntn_extracted, (SELECT count(*) FROM {incr}) AS raw_loaded, "
                         f"{dele} AS raw_deleted, CAST(NULL AS BIGINT) AS wh_loaded, CAST(NULL AS BIGINT) AS wh_closed")
    ctes["stats_loads"] = "\nUNION ALL\n".join(parts)
    return "stats_loads"


def o_stats_upsert() -> str:
    ctes = {}
    return with_sql(ctes, _sel(_load_counts_ctes(ctes)))


def o_run_stats() -> str:
    ctes = {}
    parts = []
    for e in ENTITY_NAMES:
        n = load_runs_cte(ctes, e)
        parts.append(f"SELECT '{e}' AS entity, (SELECT count(*) FROM {n['incr2']}) AS ntn_extracted, "
                     f"(SELECT count(*) FROM {n['incr2']}) AS raw_loaded, "
                     f"(SELECT count(*) FROM {n['removed2']}) AS raw_deleted")
    return with_sql(ctes, "\nUNION ALL\n".join(parts))


def _wh_ctes(ctes: dict, snaps=tuple(f"dim_{e}" for e in DIM_ENTITIES)) -> str:
    hist = {n: snapshot_runs_cte(ctes, n, TWO_RUNS) for n in snaps}
    hi = TS(RUN_TS[2])
    lo = f"({hi} - INTERVAL 2 MINUTES)"
    parts = []
    for n, d in hist.items():
        e, key = B.SNAPSHOTS[n].entity_name(), B.SNAPSHOTS[n].key
        live = raw_cte(ctes, e, 2)
        parts.append(
            f"SELECT '{n}' AS table_name, 'extract_and_load_{e}' AS task_name, "
            f"(SELECT count(*) FROM {d} WHERE scd2_valid_from BETWEEN {lo} AND {hi}) AS wh_loaded, "
            f"(SELECT count(*) FROM (SELECT {key} FROM {d} WHERE {key} <> '-1' "
            f"AND scd2_valid_to BETWEEN {lo} AND {hi} EXCEPT SELECT id FROM {live})) AS wh_closed")
    ctes["wh_counts"] = "\nUNION ALL\n".join(parts)
    return "wh_counts"


def o_stats_wh(kind: str):
    def o():
        ctes = {}
        w = _wh_ctes(ctes)
        return with_sql(ctes, f"SELECT table_name, task_name, {kind} FROM {w}")
    return o


def o_stats_by_table() -> str:
    ctes = {}
    st = _load_counts_ctes(ctes)
    w = _wh_ctes(ctes, tuple(B.SNAPSHOTS))
    cols = "run_id, run_date, dag_name, s.task_name, ntn_extracted, raw_loaded, raw_deleted"
    return with_sql(ctes, f"""SELECT {cols},
       CASE WHEN w.task_name IS NOT NULL THEN w.wh_loaded ELSE s.wh_loaded END AS wh_loaded,
       CASE WHEN w.task_name IS NOT NULL THEN w.wh_closed ELSE s.wh_closed END AS wh_closed
FROM {st} s LEFT JOIN {w} w ON w.task_name = s.task_name AND s.run_id = {_run_id(2)}""")


# ---------------------------------------------------------------- documents
_ISO_MS = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def o_page_explode() -> str:
    ctes = {"raw_transaction_base": RAW_BASE["transaction"]}
    return with_sql(ctes, f"SELECT id, {_ISO_MS.format(c='created_time')} AS created_time, "
                          f"{_ISO_MS.format(c='last_edited_time')} AS last_edited_time, false AS archived "
                          "FROM raw_transaction_base")


def o_page_pruned() -> str:
    ctes = {"raw_transaction_base": RAW_BASE["transaction"]}
    return with_sql(ctes, "SELECT id, title FROM raw_transaction_base")


def o_map(entity):
    def o():
        ctes = {}
        return with_sql(ctes, _sel(raw_cte(ctes, entity, 1)))
    return o


def o_map_year_month() -> str:
    ctes = {}
    y, m = raw_cte(ctes, "year", 1), raw_cte(ctes, "month", 1)
    return with_sql(ctes, f"SELECT 'year' AS entity, * FROM {y}\nUNION ALL\nSELECT 'month' AS entity, * FROM {m}")


def o_ids_audit() -> str:
    ctes = {}
    parts = []
    for e in ENTITY_NAMES:
        src = raw_cte(ctes, e, 2 if e == "subcategory" else 1)
        parts.append(f"SELECT id, title, '{e}' AS source_name FROM {src}")
    return with_sql(ctes, "\nUNION ALL\n".join(parts))


def o_json_path() -> str:
    return "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"


# ------------------------------------------------------------------- bronze
def o_bronze_roundtrip() -> str:
    ctes = {}
    return with_sql(ctes, _sel(raw_cte(ctes, "transaction", 1)))


# --------------------------------------------------------------------- jobs
def _job_state_ctes(ctes: dict) -> dict[str, str]:
    """Raw tables after the two job runs: kept2 of each entity's loads."""
    return {e: load_runs_cte(ctes, e)["kept2"] for e in ENTITY_NAMES}


def o_warehouse_build() -> str:
    ctes = {}
    raw = _job_state_ctes(ctes)
    dims = dims_two_runs(ctes)
    ctes["stg_transaction_job"] = staging_sql("stg_transaction", raw["transaction"], raw["subcategory"])
    ctes["dim_date_job"] = dim_date_sql("orders", "o_orderdate")
    return with_sql(ctes, fact_sql("fact_transaction", "stg_transaction_job", dims, "dim_date_job"))


def o_dq_failures() -> str:
    ctes = {}
    raw = _job_state_ctes(ctes)
    stg = {}
    for n, spec in B.STAGING.items():
        parent = raw[spec.lookup[0]] if spec.lookup else None
        ctes[f"{n}_job"] = staging_sql(n, raw[spec.raw_table], parent)
        stg[n] = f"{n}_job"
    return with_sql(ctes, f"SELECT test_name, failures AS stored_rows FROM ({summary_sql(B.STAGING_CHECKS, stg)}) "
                          "WHERE failures > 0")


def o_stream_landing_upsert() -> str:
    ctes = {}
    b1, b2 = raw_cte(ctes, "subcategory", 1), raw_cte(ctes, "subcategory", 2)
    return with_sql(ctes, f"SELECT * EXCLUDE (load_date) FROM (SELECT * FROM {b1} t WHERE NOT EXISTS "
                          f"(SELECT 1 FROM {b2} b WHERE b.id = t.id)\nUNION ALL\nSELECT * FROM {b2})")


ORACLE = {
    **{n: o_stg(n) for n in ("stg_account", "stg_category", "stg_subcategory", "stg_transaction", "stg_budget")},
    "stg_year_month": o_stg_year_month,
    **{n: o_scd2_case(n) for n in SCD2_CASES},
    **{f"scd2_changes_{s}": o_scd2_case("scd2_two_batches") for s in ("wide", "narrow")},
    **{f"scd2_{n}": o_scd2_spec(n) for n in ("dim_account", "dim_category", "dim_subcategory")},
    "scd2_dim_year_month": o_scd2_dim_year_month,
    "scd2_transaction_log": o_scd2_spec("fact_transaction_audit_log"),
    "scd2_budget_log": o_scd2_spec("fact_budget_audit_log"),
    "asof_single": o_asof_single,
    "asof_boundary": o_asof_boundary,
    "asof_sorted": o_asof_single,
    "asof_sorted_boundary": o_asof_boundary,
    "unknown_member": o_unknown_member,
    "fact_transaction": o_fact_transaction,
    "fact_budget": o_fact_budget,
    "fact_transaction_feed": o_fact_transaction,
    "fact_budget_feed": o_fact_budget,
    "dim_date": o_dim_date,
    "watermark": o_watermark,
    "incremental_filter": o_load_step("subcategory", "incr2"),
    "incremental_full": o_incremental_full,
    "txn_source_filter": o_txn_source_filter,
    "txn_turned_planned": o_txn_turned_planned,
    "raw_upsert": o_load_step("subcategory", "ups2"),
    "raw_upsert_empty": o_load_step("subcategory", "ups2", NONE),
    "hard_delete_keep": o_load_step("subcategory", "kept2"),
    "sync_deletes_small": o_load_step("subcategory", "kept2"),
    "sync_deletes_large": o_load_step("subcategory", "kept2"),
    "hard_delete_removed": o_load_step("subcategory", "removed2"),
    "reset_dates": o_reset_dates,
    "cast_text": o_cast_text,
    "cast_decimal": o_cast_decimal,
    "cast_temporal": o_cast_temporal,
    "run_id_format": o_run_id_format,
    "dq_unique": o_dq_unique,
    "dq_unique_composite": o_dq_unique_composite,
    "dq_not_null": o_dq_not_null,
    "dq_accepted_values": o_dq_accepted_values,
    "dq_primary_key": o_dq_primary_key,
    "dq_foreign_key": o_dq_foreign_key,
    "dq_singular_warn": o_dq_singular_warn,
    "dq_summary": o_dq_summary,
    "stats_upsert": o_stats_upsert,
    "run_stats": o_run_stats,
    "stats_wh_loaded": o_stats_wh("wh_loaded"),
    "stats_wh_closed": o_stats_wh("wh_closed"),
    "stats_by_table": o_stats_by_table,
    "page_explode": o_page_explode,
    "page_pruned": o_page_pruned,
    **{f"map_{e}": o_map(e) for e in ("account", "category", "subcategory", "budget", "transaction")},
    "map_year_month": o_map_year_month,
    "ids_audit": o_ids_audit,
    "json_path": o_json_path,
    "bronze_roundtrip": o_bronze_roundtrip,
    "bronze_replay": o_load_step("subcategory", "ups2"),
    "entity_load": o_load_step("subcategory", "kept2"),
    "upsert_bucketed": o_load_step("subcategory", "ups2"),
    "delete_sync_bucketed": o_load_step("subcategory", "kept2"),
    "entity_load_bucketed": o_load_step("subcategory", "kept2"),
    "warehouse_build": o_warehouse_build,
    "dq_failures": o_dq_failures,
    "stream_landing_upsert": o_stream_landing_upsert,
    "stream_bronze_append": o_stream_landing_upsert,
    "scd2_stream": o_scd2_case("scd2_two_batches"),
}


def oracle_sql() -> dict[str, str]:
    return {k: f() for k, f in ORACLE.items()}
