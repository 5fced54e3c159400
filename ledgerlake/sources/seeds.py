"""Typed seed files (S7): a CSV with a header, read with given column types.

The reference loads its date dimension from a seed file with declared column
types.  ``numeric(n)`` maps to ``int``, ``varchar(n)`` to text cut to n
characters, ``date`` to ``date``.  Column names may contain '-'.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalar import text

_VARCHAR = re.compile(r"varchar\((\d+)\)", re.I)
_NUMERIC = re.compile(r"numeric\((\d+)\)", re.I)


def seed_column(name: str, declared: str):
    c = F.col(f"`{name}`")
    if m := _VARCHAR.fullmatch(declared.strip()):
        return text(c, int(m.group(1))).alias(name)
    if _NUMERIC.fullmatch(declared.strip()):
        return c.cast("int").alias(name)
    return c.cast(declared).alias(name)


def read_seed(spark: SparkSession, path: str, column_types: dict[str, str]) -> DataFrame:
    """Read a seed CSV (all text) and apply the declared types in the given order."""
    raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    return raw.select(*[seed_column(n, t) for n, t in column_types.items()])


# Declared column types of the date seed.
DIM_DATE_TYPES = {
    "dk": "varchar(10)", "date": "date", "full_date_description": "varchar(30)", "day_of_week": "varchar(9)",
    "day_number_in_calendar_month": "numeric(2)", "day_number_in_calendar_year": "numeric(3)",
    "last_day_in_month_indicator": "varchar(3)", "calendar_week_ending_date": "date",
    "calendar_week_number_in_year": "numeric(2)", "calendar_month_name": "varchar(9)",
    "calendar_month_number_in_year": "varchar(12)", "calendar_year-month": "varchar(7)",
    "calendar_quarter": "varchar(2)", "calendar_year-quarter": "varchar(7)", "calendar_year": "varchar(4)",
    "holiday_indicator": "varchar(11)", "weekday_indicator": "varchar(7)",
}
