from pyspark.sql import functions as F

import corpus_pipeline


def test_stages_on_awkward_rows(spark, rows, sf, tmp_path):
    docs = rows.drop("score")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        assert set(docs.columns) <= set(out.columns), name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    texts = [r.text for r in docs.collect()]
    assert "Call me at [EMAIL] or [PHONE]." in texts and texts.count("Call me at [EMAIL] or [PHONE].") == 1


def test_run_keeps_each_document_once(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert 0 < out.count() <= n and out.count() == out.select("doc_id").distinct().count()
    assert out.select(F.max(F.struct("slot", "place"))).first()[0] is not None


def test_empty(spark, rows, sf):
    docs = rows.drop("score").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
