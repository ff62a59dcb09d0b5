"""Language by held-out accuracy; the stages one by one, and on awkward rows."""

from pyspark.sql import functions as F
from texts import awkward, empty

import corpus_pipeline
from revtide.llm import compression, langid
from revtide.llm.queries import op8_hierarchical_language


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = op8_hierarchical_language(spark, sf_dir).join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert len(rows) > 100 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    rows = awkward(spark)
    for model in (langid.train(rows), langid.train(empty(spark))):
        found = langid.predicted(rows, model).collect()
        assert len(found) == rows.count()
        assert all(r["language"]["lang_pred"] == "und" for r in found if not langid.has_letter(r["row"]["text"]))


def test_stages(spark, sf_dir):
    docs = corpus_pipeline.documents(spark, sf_dir)
    kept = corpus_pipeline.quality_rules(spark, docs, sf_dir)
    assert kept.count() == compression.judged(docs).filter("quality.kept").count()
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, kept, sf_dir).columns == docs.columns
    last = corpus_pipeline.run(spark, sf_dir)
    assert last.filter(~F.col("round_trip")).count() == 0 and last.count() > 0


def test_stages_on_awkward_rows(spark, sf_dir):
    for rows in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, rows, sf_dir).collect()


def test_documents_without_a_language_to_learn(spark, sf_dir):
    rows = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, rows, sf_dir).count() == rows.count()
