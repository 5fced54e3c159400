import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=None):
        """rows: (doc_id, text) or (doc_id, text, lang); extra: names of clashing columns."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        from pyspark.sql import functions as F
        for name in extra or ():
            df = df.withColumn(name, F.lit("x"))
        return df
    return make
