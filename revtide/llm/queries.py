"""Registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.llm import (
    ann, bpe, chat, compression, langid, license, mixing, oddsketch, ranking, simhash, sitestyle, warc,
    whitening,
)
from revtide.llm.common import WORD, documents, word_count
from revtide.session import stored


def op1_adaptive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every row whose vec_id is divisible by 100."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.search(rows, F.col("vec_id") % 100 == 0)


def op2_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = sitestyle.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return pages.select(
        "row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op3_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    coded = bpe.decoded(bpe.encoded(documents(spark, sf_dir)))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


def op4_typed_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back, and one full of control strings."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    rows = rows.unionByName(
        spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema)
    )
    return chat.read_back(chat.formatted(rows, chat.text_part(F.col("text"))))


def op5_vantage_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.grouped(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex_digits(F.col("point")).alias("fingerprint"), "component_id"
    )


def op6_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    found = compression.judged(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("row.doc_id", "quality.*")


def op7_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses stated in every document."""
    return license.listed(documents(spark, sf_dir).select("doc_id", "text"))


def op8_hierarchical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    rows = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = langid.predicted(rows, langid.train(rows))
    return found.select(
        "row.doc_id", langid.held_out(F.col("row.doc_id")).alias("held_out"), "language.lang_pred",
        "language.score",
    )


def op9_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, normalised, and read back."""
    records = warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"), payloads=False)
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op10_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    rows = documents(spark, sf_dir)
    narrow = stored(rows.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    drawn = mixing.mixed(narrow, "source", F.col("size"), [F.col("doc_id")])
    return drawn.select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op11_bag_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranking.ranking(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set and component of every document."""
    found = oddsketch.grouped(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", F.expr("id <=> component_id").alias("kept")
    )


def op13_bidiagonal_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding, whitened."""
    rows = whitening.prepared(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    found = whitening.whitened(rows, whitening.fitted(rows))
    # Where n is so large that a long cannot hold the deviation, it is null.
    return found.select(
        "row.vec_id", "component", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), "whitened",
        "explained", "identity_error",
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_adaptive_ann, op2_site_style_tree, op3_segment_tree_bpe, op4_typed_chat, op5_vantage_simhash,
        op6_compression_bands, op7_license_windows, op8_hierarchical_language, op9_warc_members,
        op10_systematic_mix, op11_bag_ranking, op12_odd_sketches, op13_bidiagonal_whitening, pipeline,
    )
}

ORACLE = {
    "op4_typed_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), marked AS (
            SELECT *, coalesce(role, '') AS name, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(name || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
            CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
            sha256(string_agg(loss, '' ORDER BY turn)) AS loss_sha256,
            CAST(sum(20 + length(regexp_replace(name, '([\\<#:])', '\\\1', 'g'))
                + length(regexp_replace(text, '([\\<#])', '\\\1', 'g'))) AS BIGINT) AS formatted_chars,
            CAST(0 AS BIGINT) AS attachments, CAST(0 AS BIGINT) AS attachment_tokens
        FROM marked GROUP BY conv_id
    """,
    "op9_warc_members": """
        WITH p AS (
            SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 1000
                THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN first > page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first > page_id THEN first END AS refers_to
        FROM f
    """,
    "op10_systematic_mix": rf"""
        WITH sizes AS (
            SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size
            FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS weight
            FROM sizes GROUP BY source
        ), steps AS (
            SELECT *, 2 * source_size AS most,
                row_number() OVER (ORDER BY source_size / CAST(weight AS DOUBLE), source) AS step,
                CAST(sum(source_size) OVER () AS BIGINT) AS total,
                CAST(coalesce(sum(source_size) OVER (ORDER BY source_size / CAST(weight AS DOUBLE), source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS full_size,
                CAST(sum(weight) OVER (ORDER BY source_size / CAST(weight AS DOUBLE), source
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS free
            FROM sources
        ), levels AS (
            SELECT *, (1.5::DOUBLE * total - 2 * full_size) / free AS level FROM steps
        ), chosen AS (
            SELECT level FROM levels WHERE weight * level <= most ORDER BY step LIMIT 1
        ), goals AS (
            SELECT source, source_size, least(weight * level, most)::DOUBLE AS target FROM sources,
                LATERAL (SELECT 2 * source_size AS most), chosen
        ), ranks AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS k,
                CAST(('0x' || substr(md5('mix-1' || coalesce(':' || source, '')), 1, 8)) AS BIGINT)
                    / 4294967296.0::DOUBLE AS start
            FROM sizes
        ), copies AS (
            SELECT r.*, g.source_size, g.target, g.target / g.source_size AS rate
            FROM ranks r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source
        )
        SELECT doc_id, size, source_size, target,
            CAST(least(coalesce(floor(start + k * rate) - floor(start + (k - 1) * rate), 0), 2) AS BIGINT) * size
                AS taken
        FROM copies
    """,
    "op11_bag_ranking": r"""
        WITH found AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents WHERE text IS NOT NULL
        ), docs AS (
            SELECT row, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM found WHERE len(terms) > 0
        ), corpus AS (
            SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs
        ), asked AS (
            SELECT item_id, unnest(list_distinct(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
            FROM benchmark
        ), held AS (
            SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs)
            WHERE term IN (SELECT term FROM asked) GROUP BY row, term
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM held GROUP BY term), corpus
        ), points AS (
            SELECT row, held.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))
                AS points
            FROM held JOIN docs USING (row) JOIN weights ON weights.term = held.term, corpus
        ), scores AS (
            SELECT item_id, row, CAST(sum(points) AS BIGINT) AS score
            FROM asked JOIN points USING (term) GROUP BY item_id, row
        ), ranked AS (
            SELECT item_id, doc_id, score, row_number() OVER (
                PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM scores JOIN docs USING (row) WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
    "op12_odd_sketches": rf"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(words) >= 3 THEN list_distinct(list_transform(range(1, len(words) - 1),
                    lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))
                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
            FROM worded
        ), sizes AS (
            SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n FROM sets
        ), members AS (
            SELECT doc_id, unnest(shingles) AS shingle FROM sets
        ), shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
            FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * common >= 85 * (x.n + y.n - common)
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM sizes
            UNION
            SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
        ), least AS (
            SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
        )
        SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sizes JOIN least USING (doc_id)
    """,
}
