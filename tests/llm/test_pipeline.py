"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from mailtriage.llm import minhash, toxicity
from mailtriage.session import staged_table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "minhash", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = staged_table(stage(spark, docs, SF), name)
        assert after.schema.names == docs.schema.names
        assert after.count() <= docs.count()
        if name == "minhash":
            assert minhash.near_duplicates(docs).where("kept").select("doc_id").exceptAll(after.select("doc_id")).isEmpty()
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_toxic_rows_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.clean_toxic(spark, docs, "/root/testdata/sf0.01")
    lexicon = toxicity.fit(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    gone = toxicity.score(docs, lexicon).where("predicted = 1").select("doc_id")
    assert kept.join(gone, "doc_id").isEmpty() and kept.count() + gone.count() == docs.count()
