from ledgerlake.functions.scalar import (  # noqa: F401
    bool_text,
    changed_any,
    entity_of_table,
    first_or_null,
    json_path,
    money,
    run_id_expr,
    run_id_value,
    scd_key,
    text,
    to_date,
    to_ts,
    ts_literal,
)
