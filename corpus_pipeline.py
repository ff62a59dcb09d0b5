"""Corpus pipeline: from ``documents`` to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the
columns of ``documents``. A stage's result is written as Parquet and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.llm import bpe, compression, langid, mixing, simhash
from revtide.llm.common import documents, word_count
from revtide.session import stored

#: Texts whose language is less sure than this go.
MIN_LANGUAGE_SCORE = 0.25


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return compression.kept(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learnt from the documents at hand. Without a language to learn, all."""
    model = langid.train(docs)
    if not model.tree:
        return docs
    found = langid.predicted(docs, model)
    sure = (F.col("language.lang_pred") != langid.UNDETERMINED) & (
        F.col("language.score") >= MIN_LANGUAGE_SCORE
    )
    return found.filter(sure).select("row.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return simhash.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs, "source", word_count(docs["text"]), [docs["doc_id"], F.xxhash64(docs["text"])])


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    coded = bpe.decoded(bpe.encoded(docs, keep=("doc_id", "lang", "source", "text")))
    return coded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.col("raw") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_dedup),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

# Compression ratios, vector machines, hashes over shingles and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored before the next one reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
