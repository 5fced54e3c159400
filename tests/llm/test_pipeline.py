import corpus_pipeline as P
from ledgerlake.llm import packing


def test_stages_on_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        ids = [r["doc_id"] for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) <= docs.count()
        path = packing.stored(out, "test")
        docs = path
    left = {r["doc_id"] for r in docs.collect()}
    rows = P.run(spark, sf).collect()
    assert {r["doc_id"] for r in rows} == left and all(r["offset"] + r["length"] <= 4096 for r in rows)


def test_stages_on_empty_table(spark, make_docs, sf):
    for _, stage in P.STAGES:
        assert stage(spark, make_docs([]), sf).count() == 0
