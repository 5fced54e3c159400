"""Specs of the warehouse: seven source entities, their staging models,
snapshots, facts and data tests.  The operators are generic; everything
entity-specific is here.
"""

from __future__ import annotations

from ledgerlake.spec import (Cast, Check, DimRef, EntitySpec, FactSpec, Prop,
                             SnapshotSpec, StagingSpec, SYSTEM_KEY, SYSTEM_TIME)

# ---------------------------------------------------------------------------
# Document property names (as the source names them), their kind
# and the raw column each one fills; the order of the entity loads; the status
# value of a planned transaction; allowed values of the data tests.
# ---------------------------------------------------------------------------
PLANNED_STATUS = "Предстои"
INCOME, EXPENSE = "Приход", "Разход"
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December")

ACCOUNT = EntitySpec("account", (
    Prop("Name", "title", "title"),
    Prop("Архивирай", "is_archived", "checkbox"),
))
CATEGORY = EntitySpec("category", (
    Prop("Name", "title", "title"),
    Prop("Тип", "type", "select"),
    Prop("Архивирай", "is_archived", "checkbox"),
))
SUBCATEGORY = EntitySpec("subcategory", (
    Prop("Име", "title", "title"),
    Prop("Тип", "type", "select"),
    Prop("Сметка", "account_id", "relation"),
    Prop("Категория", "category_id", "relation"),
    Prop("Необходимост", "flex_type", "select"),
    Prop("Падеж", "due_date", "date"),
    Prop("Архивирай", "is_archived", "checkbox"),
), title_prop="Име")
YEAR = EntitySpec("year", (
    Prop("Име", "title", "title"),
), title_prop="Име")
MONTH = EntitySpec("month", (
    Prop("Name", "title", "title"),
))
BUDGET = EntitySpec("budget", (
    Prop("Name", "title", "title"),
    Prop("Край период", "period_end", "date"),
    Prop("Бюджет", "budget_amount", "number"),
    Prop("Година", "year_id", "relation"),
    Prop("Месец", "month_id", "relation"),
    Prop("Подкатегория", "subcategory_id", "relation"),
    Prop("Скрита", "is_archived", "checkbox"),
))
TRANSACTION = EntitySpec("transaction", (
    Prop("Name", "title", "title"),
    Prop("Тип", "type", "select"),
    Prop("Дата", "date", "date"),
    Prop("Сума", "amount", "number"),
    Prop("Статус", "status", "select"),
    Prop("Бележка", "note", "rich_text"),
    Prop("Година", "year_id", "relation"),
    Prop("Месец", "month_id", "relation"),
    Prop("Подкатегория", "subcategory_id", "relation"),
    Prop("Template", "is_template", "checkbox"),
), exclude_equal=(("is_template", True), ("status", PLANNED_STATUS)))

ENTITY_ORDER = (ACCOUNT, CATEGORY, SUBCATEGORY, YEAR, MONTH, BUDGET, TRANSACTION)
ENTITIES = {e.name: e for e in ENTITY_ORDER}

# Raw column types (documents give text for dates and relation ids).
RAW_TYPES = {"title": "string", "rich_text": "string", "select": "string", "date": "string",
             "number": "double", "relation": "string", "checkbox": "boolean"}


def _ts():
    return (Cast("created_time", "created_time", "timestamp"),
            Cast("last_edited_time", "last_edited_time", "timestamp"))


_SYS = {"created_time": SYSTEM_TIME, "last_edited_time": SYSTEM_TIME}

# ---------------------------------------------------------------------------
# Staging models (fixed values: names, text widths, system rows)
# ---------------------------------------------------------------------------
STG_ACCOUNT = StagingSpec("stg_account", "account", (
    Cast("account_id_bk", "id", "text", 100),
    Cast("account_name", "title", "text", 25),
    Cast("is_archived", "is_archived", "text", 5),
    *_ts()), key="account_id_bk",
    system_row={"account_id_bk": SYSTEM_KEY, "account_name": SYSTEM_KEY, "is_archived": "false", **_SYS})

STG_CATEGORY = StagingSpec("stg_category", "category", (
    Cast("category_id_bk", "id", "text", 100),
    Cast("category_name", "title", "text", 50),
    Cast("category_type", "type", "text", 20),
    Cast("is_archived", "is_archived", "text", 5),
    *_ts()), key="category_id_bk",
    system_row={"category_id_bk": SYSTEM_KEY, "category_name": SYSTEM_KEY, "category_type": SYSTEM_KEY,
                "is_archived": "false", **_SYS})

STG_SUBCATEGORY = StagingSpec("stg_subcategory", "subcategory", (
    Cast("subcategory_id_bk", "id", "text", 100),
    Cast("subcategory_name", "title", "text", 50),
    Cast("subcategory_type", "type", "text", 20),
    Cast("account_id", "account_id", "text", 50),
    Cast("category_id", "category_id", "text", 50),
    Cast("priority", "flex_type", "text", 15),
    Cast("due_date", "due_date", "date"),
    Cast("is_archived", "is_archived", "text", 5),
    *_ts()), key="subcategory_id_bk",
    system_row={"subcategory_id_bk": SYSTEM_KEY, "subcategory_name": SYSTEM_KEY, "subcategory_type": SYSTEM_KEY,
                "account_id": SYSTEM_KEY, "category_id": SYSTEM_KEY, "priority": SYSTEM_KEY,
                "due_date": None, "is_archived": "false", **_SYS})

STG_YEAR = StagingSpec("stg_year", "year", (
    Cast("year_id_bk", "id", "text", 100),
    Cast("year_name", "title", "text", 4),
    *_ts()), key="year_id_bk",
    system_row={"year_id_bk": SYSTEM_KEY, "year_name": SYSTEM_KEY, **_SYS})

STG_MONTH = StagingSpec("stg_month", "month", (
    Cast("month_id_bk", "id", "text", 100),
    Cast("month_name", "title", "text", 12),
    *_ts()), key="month_id_bk",
    system_row={"month_id_bk": SYSTEM_KEY, "month_name": SYSTEM_KEY, **_SYS})

STG_TRANSACTION = StagingSpec("stg_transaction", "transaction", (
    Cast("transaction_id_bk", "id", "text", 100),
    Cast("transaction_name", "title", "text", 50),
    Cast("transaction_type", "type", "text", 20),
    Cast("transaction_date", "date", "date"),
    Cast("transaction_amount", "amount", "money"),
    Cast("transaction_status", "status", "text", 15),
    Cast("note", "note", "text", 1000),
    Cast("year_id", "year_id", "text", 100),
    Cast("month_id", "month_id", "text", 100),
    Cast("account_id", "account_id", "text", 100),
    Cast("category_id", "category_id", "text", 100),
    Cast("subcategory_id", "subcategory_id", "text", 100),
    *_ts()), key="transaction_id_bk",
    lookup=("subcategory", "subcategory_id", "id",
            {"account_id": ("account_id", 100), "category_id": ("category_id", 100)}))

STG_BUDGET = StagingSpec("stg_budget", "budget", (
    Cast("budget_id_bk", "id", "text", 100),
    Cast("budget_name", "title", "text", 50),
    Cast("period_end", "period_end", "date"),
    Cast("year_id", "year_id", "text", 100),
    Cast("month_id", "month_id", "text", 100),
    Cast("category_id", "category_id", "text", 100),
    Cast("subcategory_id", "subcategory_id", "text", 100),
    Cast("budget_amount", "budget_amount", "money"),
    Cast("is_archived", "is_archived", "text", 5),
    *_ts()), key="budget_id_bk",
    lookup=("subcategory", "subcategory_id", "id", {"category_id": ("category_id", 100)}))

STAGING = {s.name: s for s in (STG_ACCOUNT, STG_CATEGORY, STG_SUBCATEGORY, STG_YEAR, STG_MONTH,
                               STG_TRANSACTION, STG_BUDGET)}

# ---------------------------------------------------------------------------
# Snapshots (fixed values: unique key and check columns of each)
# ---------------------------------------------------------------------------
_DIM_NN = ("created_time", "last_edited_time")
DIM_ACCOUNT = SnapshotSpec("dim_account", "stg_account", "account_id_bk",
                           ("account_id_bk", "account_name", "is_archived"),
                           unique_together=("account_name", "scd2_valid_to"),
                           not_null=("account_id_bk", "account_name", "is_archived", *_DIM_NN))
DIM_CATEGORY = SnapshotSpec("dim_category", "stg_category", "category_id_bk",
                            ("category_id_bk", "category_name", "category_type", "is_archived"),
                            unique_together=("category_name", "scd2_valid_to"),
                            not_null=("category_id_bk", "category_name", "is_archived", "category_type", *_DIM_NN))
DIM_SUBCATEGORY = SnapshotSpec("dim_subcategory", "stg_subcategory", "subcategory_id_bk",
                               ("subcategory_id_bk", "subcategory_name", "subcategory_type", "priority",
                                "due_date", "is_archived"),
                               unique_together=("subcategory_name", "scd2_valid_to"),
                               not_null=("subcategory_id_bk", "subcategory_name", "subcategory_type",
                                         "is_archived", *_DIM_NN))
DIM_YEAR = SnapshotSpec("dim_year", "stg_year", "year_id_bk", ("year_id_bk", "year_name"),
                        unique_together=("year_name", "scd2_valid_to"),
                        not_null=("year_id_bk", "year_name", *_DIM_NN))
DIM_MONTH = SnapshotSpec("dim_month", "stg_month", "month_id_bk", ("month_id_bk", "month_name"),
                         unique_together=("month_name", "scd2_valid_to"),
                         not_null=("month_id_bk", "month_name", *_DIM_NN))
TRANSACTION_AUDIT_LOG = SnapshotSpec(
    "fact_transaction_audit_log", "stg_transaction", "transaction_id_bk",
    ("transaction_id_bk", "transaction_name", "transaction_type", "transaction_date", "transaction_amount",
     "transaction_status", "note", "year_id", "account_id", "category_id", "subcategory_id"))
BUDGET_AUDIT_LOG = SnapshotSpec(
    "fact_budget_audit_log", "stg_budget", "budget_id_bk",
    ("budget_id_bk", "budget_name", "period_end", "year_id", "month_id", "category_id", "subcategory_id",
     "budget_amount", "is_archived"))

SNAPSHOTS = {s.name: s for s in (DIM_ACCOUNT, DIM_CATEGORY, DIM_SUBCATEGORY, DIM_YEAR, DIM_MONTH,
                                 TRANSACTION_AUDIT_LOG, BUDGET_AUDIT_LOG)}

# ---------------------------------------------------------------------------
# Facts (fixed values: attributes and references)
# ---------------------------------------------------------------------------
FACT_TRANSACTION = FactSpec(
    "fact_transaction", "stg_transaction",
    ("transaction_id_bk", "transaction_name", "transaction_type", "transaction_date", "transaction_amount",
     "transaction_status", "note"),
    as_of="transaction_date",
    dims=(DimRef("dim_account", "account_id_bk", "account_id", "account_dk"),
          DimRef("dim_category", "category_id_bk", "category_id", "category_dk"),
          DimRef("dim_subcategory", "subcategory_id_bk", "subcategory_id", "subcategory_dk"),
          DimRef("dim_year", "year_id_bk", "year_id", "year_dk"),
          DimRef("dim_month", "month_id_bk", "month_id", "month_dk")),
    date_dim_out="date_dk", key=("transaction_id_bk",))

FACT_BUDGET = FactSpec(
    "fact_budget", "stg_budget", ("budget_id_bk", "budget_name", "period_end", "budget_amount"),
    as_of="period_end",
    dims=(DimRef("dim_category", "category_id_bk", "category_id", "category_dk"),
          DimRef("dim_subcategory", "subcategory_id_bk", "subcategory_id", "subcategory_dk"),
          DimRef("dim_year", "year_id_bk", "year_id", "year_dk"),
          DimRef("dim_month", "month_id_bk", "month_id", "month_dk")),
    key=("budget_id_bk",))

FACTS = {f.name: f for f in (FACT_TRANSACTION, FACT_BUDGET)}


# ---------------------------------------------------------------------------
# Data tests
# ---------------------------------------------------------------------------
def _staging_checks() -> list[Check]:
    bool_vals = ("true", "false", SYSTEM_KEY)
    type_vals = (INCOME, EXPENSE, SYSTEM_KEY)
    nn = {
        "stg_account": ("account_id_bk", "account_name", "is_archived", "created_time", "last_edited_time"),
        "stg_budget": ("budget_id_bk", "is_archived", "created_time", "last_edited_time"),
        "stg_category": ("category_id_bk", "category_name", "category_type", "is_archived", "created_time",
                         "last_edited_time"),
        "stg_month": ("month_id_bk", "month_name", "created_time", "last_edited_time"),
        "stg_subcategory": ("subcategory_id_bk", "subcategory_name", "subcategory_type", "account_id",
                            "category_id", "is_archived", "created_time", "last_edited_time"),
        "stg_transaction": ("transaction_id_bk", "transaction_name", "transaction_type", "transaction_date",
                            "transaction_amount", "transaction_status", "created_time", "last_edited_time"),
        "stg_year": ("year_id_bk", "year_name", "created_time", "last_edited_time"),
    }
    accepted = {
        ("stg_account", "is_archived"): bool_vals,
        ("stg_budget", "is_archived"): bool_vals,
        ("stg_category", "category_type"): type_vals,
        ("stg_category", "is_archived"): bool_vals,
        ("stg_month", "month_name"): (*MONTH_NAMES, SYSTEM_KEY),
        ("stg_subcategory", "subcategory_type"): type_vals,
        ("stg_subcategory", "is_archived"): bool_vals,
    }
    out = [Check(f"unique_{s.name}_{s.key}", s.name, "unique", (s.key,)) for s in STAGING.values()]
    out += [Check(f"not_null_{t}_{c}", t, "not_null", (c,)) for t, cols in nn.items() for c in cols]
    out += [Check(f"accepted_values_{t}_{c}", t, "accepted_values", (c,), values=v)
            for (t, c), v in accepted.items()]
    return out


def _warehouse_checks() -> list[Check]:
    out = []
    for s in SNAPSHOTS.values():
        out.append(Check(f"pk_{s.name}_dk", s.name, "primary_key", ("dk",)))
        if s.unique_together:
            out.append(Check(f"ui_{s.name}", s.name, "unique", s.unique_together))
        out += [Check(f"not_null_{s.name}_{c}", s.name, "not_null", (c,)) for c in s.not_null]
    for f in FACTS.values():
        out.append(Check(f"pk_{f.name}", f.name, "primary_key", f.key))
        out += [Check(f"not_null_{f.name}_{r.out}", f.name, "not_null", (r.out,)) for r in f.dims]
        out += [Check(f"fk_{f.name}_{r.out}", f.name, "foreign_key", (r.out,), parent=r.dim,
                      parent_columns=("dk",)) for r in f.dims]
    out += [Check("not_null_fact_transaction_transaction_id_bk", "fact_transaction", "not_null",
                  ("transaction_id_bk",)),
            Check("not_null_fact_budget_budget_id_bk", "fact_budget", "not_null", ("budget_id_bk",)),
            Check("not_null_fact_budget_period_end", "fact_budget", "not_null", ("period_end",)),
            Check("fk_fact_transaction_date_dk", "fact_transaction", "foreign_key", ("date_dk",),
                  parent="dim_date", parent_columns=("dk",)),
            Check("pk_dim_date_dk", "dim_date", "primary_key", ("dk",)),
            Check("transaction_amount_is_null", "fact_transaction", "expression",
                  condition=f"transaction_amount IS NULL AND transaction_status <> '{PLANNED_STATUS}'",
                  severity="warn")]
    return out


STAGING_CHECKS = _staging_checks()
WAREHOUSE_CHECKS = _warehouse_checks()
