"""Page documents.

The source API returns responses ``{object, results: [page, ...], has_more,
next_cursor}``; each page has ``id``, ``created_time``, ``last_edited_time``
and ``properties`` keyed by property name.  Landed responses are JSON files
(one response per line), read with an explicit schema: only the properties
the spec names are in the schema, so the JSON reader parses nothing else
(nested schema pruning).  A reader for a whole directory is split into tasks
by file blocks, so any number of landed responses is read in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, StringType, StructField,
                               StructType)

from ledgerlake.functions.scalar import first_or_null, to_ts, ts_literal
from ledgerlake.session import release_shuffles
from ledgerlake.spec import EntitySpec, Prop

_TEXT = ArrayType(StructType([StructField("plain_text", StringType())]))
_REL = ArrayType(StructType([StructField("id", StringType())]))

# Shape of each property kind in a page document.
PROPERTY_TYPES = {
    "title": StructType([StructField("title", _TEXT)]),
    "rich_text": StructType([StructField("rich_text", _TEXT)]),
    "select": StructType([StructField("select", StructType([StructField("name", StringType())]))]),
    "date": StructType([StructField("date", StructType([StructField("start", StringType()),
                                                         StructField("end", StringType())]))]),
    "number": StructType([StructField("number", DoubleType())]),
    "relation": StructType([StructField("relation", _REL)]),
    "checkbox": StructType([StructField("checkbox", BooleanType())]),
}


def page_schema(props: list[Prop] | tuple[Prop, ...]) -> StructType:
    return StructType([
        StructField("id", StringType()),
        StructField("created_time", StringType()),
        StructField("last_edited_time", StringType()),
        StructField("archived", BooleanType()),
        StructField("properties", StructType([StructField(p.name, PROPERTY_TYPES[p.kind]) for p in props])),
    ])


def response_schema(props) -> StructType:
    return StructType([
        StructField("object", StringType()),
        StructField("results", ArrayType(page_schema(props))),
        StructField("has_more", BooleanType()),
        StructField("next_cursor", StringType()),
    ])


def _props(spec: EntitySpec, only: list[str] | None) -> list[Prop]:
    if only is None:
        return list(spec.props)
    return [p for p in spec.props if p.name in set(only)]


def read_pages(spark: SparkSession, path: str, spec: EntitySpec, only: list[str] | None = None,
               multi_line: bool = False) -> DataFrame:
    """All pages of all landed responses under ``path`` (S1); ``only`` limits
    the properties read (S2).  Response order is not kept.  An unreadable
    response fails the read: a page dropped here would be deleted as gone."""
    return read_responses(spark, path, spec, only, multi_line).select(F.explode("results").alias("p")).select("p.*")


def read_responses(spark: SparkSession, path: str, spec: EntitySpec, only: list[str] | None = None,
                   multi_line: bool = False) -> DataFrame:
    schema = response_schema(_props(spec, only))
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line).json(path)


class IncompletePull(ValueError):
    """The landed responses don't hold a whole pull."""


def require_complete(spark: SparkSession, path: str, spec: EntitySpec) -> None:
    """Raises unless every landed response has results and a pull's last page
    (``has_more`` false) is among them.  Unreadable responses fail as well."""
    resp = read_responses(spark, path, spec)
    r = resp.agg(F.count_if(F.col("results").isNull()).alias("without"),
                 F.count_if(~F.col("has_more")).alias("last")).first()
    if r["without"] or not r["last"]:
        raise IncompletePull(f"{spec.name}: {r['without']} responses without results, {r['last']} last pages under {path}")


def prop_value(prop: Prop) -> Column:
    """The raw value of one property: first list element or null, struct field
    or null, scalar copied (C7, C8)."""
    c = F.col("properties").getField(prop.name)
    if prop.kind in ("title", "rich_text"):
        return first_or_null(c.getField(prop.kind)).getField("plain_text")
    if prop.kind == "relation":
        return first_or_null(c.getField("relation")).getField("id")
    if prop.kind == "select":
        return c.getField("select").getField("name")
    if prop.kind == "date":
        return c.getField("date").getField("start")
    if prop.kind in ("number", "checkbox"):
        return c.getField(prop.kind)
    raise ValueError(f"unknown property kind {prop.kind!r}")


def map_pages(pages: DataFrame, spec: EntitySpec, run_ts: str) -> DataFrame:
    """Raw rows of ``spec`` (P1-P8): id, one column per property, the page
    times as UTC timestamps, and the batch's load time."""
    return pages.select(
        F.col("id"),
        *[prop_value(p).alias(p.column) for p in spec.props],
        to_ts("created_time").alias("created_time"),
        to_ts("last_edited_time").alias("last_edited_time"),
        ts_literal(run_ts).alias("load_date"))


def skinny_pages(pages: DataFrame, spec: EntitySpec) -> DataFrame:
    """(id, title, source_name) of every page."""
    title = next(p for p in spec.props if p.name == spec.title_prop)
    return pages.select(F.col("id"), prop_value(title).alias("title"), F.lit(spec.name).alias("source_name"))


# ----------------------------------------------------------- landing (tests)
def _prop_doc(prop: Prop) -> Column:
    v = F.col(prop.column)
    t = PROPERTY_TYPES[prop.kind]
    inner = t.fields[0].dataType
    if prop.kind in ("title", "rich_text"):
        doc = F.when(v.isNull(), F.array().cast(inner)).otherwise(F.array(F.struct(v.alias("plain_text"))))
    elif prop.kind == "relation":
        doc = F.when(v.isNull(), F.array().cast(inner)).otherwise(F.array(F.struct(v.alias("id"))))
    elif prop.kind == "select":
        doc = F.when(v.isNotNull(), F.struct(v.alias("name")))
    elif prop.kind == "date":
        doc = F.when(v.isNotNull(), F.struct(v.alias("start"), F.lit(None).cast("string").alias("end")))
    else:
        doc = v
    return F.struct(doc.cast(inner).alias(t.fields[0].name)).alias(prop.name)


ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def to_pages(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """Page documents for raw rows (the inverse of ``map_pages``)."""
    return raw.select(
        F.col("id"),
        F.date_format("created_time", ISO_MILLIS).alias("created_time"),
        F.date_format("last_edited_time", ISO_MILLIS).alias("last_edited_time"),
        F.lit(False).alias("archived"),
        F.struct(*[_prop_doc(p) for p in spec.props]).alias("properties"))


def _responses(pages: DataFrame, page_size: int) -> DataFrame:
    grp = F.floor(F.monotonically_increasing_id() / page_size)
    return (pages.withColumn("__g", grp).groupBy("__g")
                 .agg(F.collect_list(F.struct(*[F.col(c) for c in pages.columns])).alias("results"))
                 .select(F.lit("list").alias("object"), "results", F.lit(False).alias("has_more"),
                         F.lit(None).cast("string").alias("next_cursor")))


def land_many(pages_by_entity: dict[str, DataFrame], root: str, page_size: int = 100) -> None:
    """Land several entities' pages, one after another, each under
    ``<root>/entity=<name>/``: what one entity shuffles is gone before the
    next is landed."""
    for name, p in pages_by_entity.items():
        land_responses(p, f"{root}/entity={name}", page_size)
        release_shuffles(p.sparkSession)


def land_responses(pages: DataFrame, path: str, page_size: int = 100) -> None:
    """Write pages as API responses of at most ``page_size`` pages each, one
    JSON response per line.  Pages are grouped within their partition (no
    global ordering), so landing is parallel.  The files are gzipped, as
    responses repeat every property's name on every page; a file is then one
    task, so it holds no more than one task's share of the pages."""
    _responses(pages, page_size).write.mode("overwrite").option("compression", "gzip").json(path)
