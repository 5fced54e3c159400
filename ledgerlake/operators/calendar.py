"""Date dimension (N1, S7): 17 columns per calendar day plus a '-1' row.

The reference loads this table from a seed file that is not published, so the
value formats below are our decision (Kimball-style texts that fit the
declared column widths).  Weeks follow ISO 8601 (Monday to Sunday); the
holiday list is a parameter.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.spec import SYSTEM_KEY

# Column names and order of the date dimension.
DIM_DATE_COLUMNS = (
    "dk", "date", "full_date_description", "day_of_week",
    "day_number_in_calendar_month", "day_number_in_calendar_year",
    "last_day_in_month_indicator", "calendar_week_ending_date",
    "calendar_week_number_in_year", "calendar_month_name",
    "calendar_month_number_in_year", "calendar_year-month", "calendar_quarter",
    "calendar_year-quarter", "calendar_year", "holiday_indicator", "weekday_indicator",
)


def calendar_attributes(days: DataFrame, holidays: list[str] | tuple = ()) -> DataFrame:
    """Attributes of each date in the ``date`` column of ``days``."""
    d = F.col("date")
    iso_dow = ((F.dayofweek(d) + 5) % 7) + 1          # Monday=1 .. Sunday=7
    hol = F.lit(False)
    if holidays:
        hol = d.isin([F.lit(h).cast("date") for h in holidays])
    return days.select(
        F.date_format(d, "yyyyMMdd").alias("dk"),
        d.alias("date"),
        F.date_format(d, "MMMM d, yyyy").alias("full_date_description"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofmonth(d).alias("day_number_in_calendar_month"),
        F.dayofyear(d).alias("day_number_in_calendar_year"),
        F.when(d == F.last_day(d), "Yes").otherwise("No").alias("last_day_in_month_indicator"),
        F.date_add(d, (7 - iso_dow).cast("int")).alias("calendar_week_ending_date"),
        F.weekofyear(d).alias("calendar_week_number_in_year"),
        F.date_format(d, "MMMM").alias("calendar_month_name"),
        F.date_format(d, "MM").alias("calendar_month_number_in_year"),
        F.date_format(d, "yyyy-MM").alias("calendar_year-month"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("calendar_quarter"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("calendar_year-quarter"),
        F.year(d).cast("string").alias("calendar_year"),
        F.when(hol, "Holiday").otherwise("Non-Holiday").alias("holiday_indicator"),
        F.when(iso_dow >= 6, "Weekend").otherwise("Weekday").alias("weekday_indicator"),
    )


def unknown_date_row(spark: SparkSession, like: DataFrame) -> DataFrame:
    """The '-1' member: key only, every attribute null."""
    return spark.range(1).select(*[
        (F.lit(SYSTEM_KEY) if f.name == "dk" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in like.schema.fields])


def dim_date(spark: SparkSession, start: str | date, end: str | date,
             holidays: list[str] | tuple = (), with_unknown: bool = True) -> DataFrame:
    """Calendar for ``start`` .. ``end`` inclusive, generated in parallel."""
    s = date.fromisoformat(str(start))
    n = (date.fromisoformat(str(end)) - s).days + 1
    days = spark.range(n).select(F.date_add(F.lit(s.isoformat()).cast("date"), F.col("id").cast("int")).alias("date"))
    out = calendar_attributes(days, holidays)
    return out.unionByName(unknown_date_row(spark, out)) if with_unknown else out


def dim_date_covering(dates: DataFrame, column: str, holidays: list[str] | tuple = (),
                      with_unknown: bool = True) -> DataFrame:
    """Calendar covering every day between the min and max of ``dates[column]``.

    The bounds come from one aggregate; the day list has one row per calendar
    day of that span (a size bound independent of the row count).
    """
    bounds = dates.agg(F.min(F.col(column).cast("date")).alias("lo"),
                       F.max(F.col(column).cast("date")).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    out = calendar_attributes(days, holidays)
    spark = dates.sparkSession
    return out.unionByName(unknown_date_row(spark, out)) if with_unknown else out
