"""The registered queries: each applies one operator to its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import align, collocations, decontaminate, huffman, jaccard, langid, linededup, neardup, packing, pii, quality, topk, toxicity
from ledgerlake.llm.common import fold, table
from ledgerlake.llm.learning import labelled_sample


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(table(spark, sf_dir, "documents"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = huffman.write_ids(table(spark, sf_dir, "documents"), byte_vocabulary)
    return huffman.read_ids(spark, path, with_ids=False)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir, "toxic", toxicity.train, 0.5)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir, "quality", quality.train, 0.3)


def scored(spark: SparkSession, sf_dir: str, label: str, train: Callable, least: float) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(*labelled_sample(docs, table(spark, sf_dir, "labels"), label))
    out = toxicity.score(docs, model, [F.col("doc_id"), (fold(F.col("doc_id"), 5) == 0).alias("held_out")])
    return out.withColumn("predicted", (F.col("score") >= least).cast("int"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_class", "kept")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pieces(table(spark, sf_dir, "documents"), word_vocabulary)
    return packing.pack(rows).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = langid.fit(docs, ~held_out, piece_vocabulary)
    return langid.predict(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.ranked(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"), byte_vocabulary, piece_vocabulary)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_pii, op2_token_ids, op3_decontaminate, op4_toxicity, op5_quality, op6_top_k, op7_near_duplicates, op8_packing,
              op9_line_dedup, op10_language, op11_jaccard_join, op12_collocations, op13_alignment)
}

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op6_top_k": TOP_K_SQL,
    "op9_line_dedup": linededup.LINE_REPORT_SQL,
    "op11_jaccard_join": jaccard.JOINED_SQL,
    "op12_collocations": collocations.PHRASES_SQL,
}
