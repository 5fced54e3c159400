"""Scalar column functions (C1-C14).  All built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.spec import RUN_ID_MISSING, RUN_ID_ZONE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text(x, n: int | None = None) -> Column:
    """Text cast that cuts to ``n`` characters, as a ``varchar(n)`` cast does.

    Spark's ``cast(x as varchar(n))`` does not cut, so cut explicitly.
    """
    s = _c(x).cast("string")
    return s if n is None else F.substring(s, 1, n)


def money(x) -> Column:
    """numeric(27,2); double input is rounded half-up by the cast."""
    return _c(x).cast("decimal(27,2)")


def to_date(x) -> Column:
    """Date cast.  A full ISO date-time string casts to its date part."""
    return _c(x).cast("date")


def to_ts(x) -> Column:
    """Zone-less UTC timestamp from an ISO-8601 string (offset honoured),
    a date, or a timestamp.

    Parsing the text straight to ``timestamp_ntz`` would drop a ``+02:00``
    offset, so parse as a zoned timestamp (session zone UTC) and then drop the
    zone.
    """
    return _c(x).cast("timestamp").cast("timestamp_ntz")


def ts_literal(s: str) -> Column:
    """A ``timestamp_ntz`` literal, e.g. a run time passed in by the job."""
    return F.lit(s).cast("timestamp_ntz")


def bool_text(x) -> Column:
    """Boolean kept as text: 'true' / 'false'."""
    return _c(x).cast("string")


def first_or_null(arr) -> Column:
    """First element of a list, null when the list is empty or null.

    ``arr[0]`` raises on an empty list under ANSI mode; ``try_element_at`` does not.
    """
    return F.try_element_at(_c(arr), F.lit(1))


def json_path(x, path: str) -> Column:
    """Nested path in a JSON text, null when missing (e.g. ``$.k``)."""
    return F.get_json_object(_c(x), path)


def scd_key(key, updated_at) -> Column:
    """Surrogate key of a snapshot version: md5 of ``key|updated_at``."""
    return F.md5(F.concat(F.coalesce(_c(key).cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(_c(updated_at).cast("string"), F.lit(""))))


def changed_any(pairs: list[tuple[Column, Column]]) -> Column:
    """Null-safe "any column differs" over (old, new) column pairs."""
    if not pairs:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [~a.eqNullSafe(b) for a, b in pairs])


def run_id_expr(x) -> Column:
    """Run id from a text: an ISO time (has a 'T') becomes local time in the
    run-id zone written ``yyyyMMddHHmmss``; digits pass through; null gives the
    missing-run id.
    """
    s = _c(x).cast("string")
    local = F.from_utc_timestamp(F.to_timestamp(s), RUN_ID_ZONE)
    return (F.when(s.isNull(), F.lit(RUN_ID_MISSING).cast("bigint"))
             .when(s.contains("T"), F.date_format(local, "yyyyMMddHHmmss").cast("bigint"))
             .otherwise(s.cast("bigint")))


def run_id_value(raw: object | None) -> int:
    """Driver-side twin of :func:`run_id_expr` for the one value a job needs."""
    if raw is None or raw == "":
        return RUN_ID_MISSING
    if isinstance(raw, str) and "T" in raw:
        t = datetime.fromisoformat(raw.replace("Z", "+00:00"))
        if t.tzinfo is None:
            t = t.replace(tzinfo=timezone.utc)
        return int(t.astimezone(ZoneInfo(RUN_ID_ZONE)).strftime("%Y%m%d%H%M%S"))
    return int(raw)


def entity_of_table(x) -> Column:
    """Entity name from a table name: its second '_' part
    (``fact_transaction_audit_log`` -> ``transaction``)."""
    return F.split_part(_c(x), F.lit("_"), F.lit(2))
