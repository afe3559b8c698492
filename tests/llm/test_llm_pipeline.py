"""The pipeline: each stage's contract, awkward inputs, and the stages' effects together."""

import corpus_pipeline
from llm_cases import documents, empty
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_awkward_documents(spark):
    for docs in (documents(spark), empty(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == columns and out.schema.simpleString() == docs.schema.simpleString(), name
            stage(spark, docs.filter("doc_id IS NULL"), SF).count()
            docs = corpus_pipeline.materialize(out, "test")
        docs.count()


def test_run(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "MinHash near-dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.materialize(corpus_pipeline.quality_rules(spark, docs, SF), "t")
    assert good.columns == COLUMNS and 0 < good.count() < docs.count()
    lined = corpus_pipeline.materialize(corpus_pipeline.line_dedup(spark, good, SF), "t")
    assert lined.count() == good.count() and lined.filter(F.length("text") != F.col("n_chars")).count() == 0
    near = corpus_pipeline.materialize(corpus_pipeline.near_dedup(spark, lined, SF), "t")
    assert 0 < near.count() <= lined.count()
    mix = corpus_pipeline.materialize(corpus_pipeline.mix_sources(spark, near, SF), "t")
    packed = corpus_pipeline.pack_sequences(spark, mix, SF)
    ends = packed.filter("start = 0").count()
    assert ends == mix.count()
    assert corpus_pipeline.run(spark, SF).count() == packed.count()
