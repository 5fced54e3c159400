"""The bounded sample of labelled rows that a classifier is fitted on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fold

# At most so many rows of each label, and only texts of at most so many
# characters, are learned from; scoring covers every whole text.
SAMPLE_ROWS = 1500
SAMPLE_CHARS = 12_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column | None = None,
                    rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[list[str], np.ndarray]:
    """Texts and labels (0 or 1) of the rows that ``learn`` (a condition on
    doc_id) picks, chosen by the text's hash; equal texts count once."""
    learn = fold(F.col("doc_id"), 5) != 0 if learn is None else learn
    own = labels.filter(F.col(label).isin(0, 1) & learn).select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    texts = docs.filter(learn & F.col("text").isNotNull() & (F.length("text") <= chars)).select("doc_id", F.xxhash64("text").alias("h"), "text")
    # ids and hashes choose; only the chosen texts, 2 * rows at most, are then read
    able = texts.select("doc_id", "h").join(own, "doc_id").select("h", "label").distinct()
    chosen = able.filter("label = 0").orderBy("h").limit(rows).unionByName(able.filter("label = 1").orderBy("h").limit(rows))
    found = texts.select("h", "text").join(F.broadcast(chosen), "h").groupBy("h", "label").agg(F.min("text").alias("text"))
    out = [(r["text"], r["label"]) for r in found.orderBy("label", "h").collect()]
    return [t for t, _ in out], np.array([v for _, v in out], np.int64)
