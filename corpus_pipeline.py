"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written and read back as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, linededup, neardup, packing, toxicity
from ledgerlake.llm.common import stored, table
from ledgerlake.llm.learning import labelled_sample
from ledgerlake.llm.queries import word_vocabulary
from ledgerlake.session import configure

TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under ``TOXIC``.  The model learns from the rows of
    ``docs`` with a label, but for those held out by their id."""
    model = toxicity.train(*labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic"))
    scored = toxicity.score(docs, model, [F.col(c) for c in docs.columns])
    return scored.filter(F.col("score") < TOXIC).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line equals or nearly equals go."""
    return linededup.dedup_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return neardup.dedup(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequence and place in it."""
    rows = packing.pack(packing.pieces(docs, word_vocabulary))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near-dedup", dedup_documents),
    ("decontamination", decontaminated),
    ("packing", pack),
]

# The trained classifier, the sketches and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
