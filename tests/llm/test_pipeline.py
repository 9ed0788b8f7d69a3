"""The stages on odd rows, each against what its operator decides."""

import corpus_pipeline as pipeline

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_rows(spark, documents):
    docs = documents
    for name, step in pipeline.STAGES[:-1]:
        after = pipeline.stage(step(spark, docs, FOLDER), name)
        assert after.columns == docs.columns and after.schema.simpleString() == docs.schema.simpleString()
        assert step(spark, docs.limit(0), FOLDER).count() == 0
        docs = after
    assert "[SECRET]" in docs.where("doc_id = 6").first().text
    mixed = pipeline.mix_sources(spark, docs, FOLDER)
    assert mixed.columns[: len(docs.columns)] == docs.columns and mixed.count() > 0
