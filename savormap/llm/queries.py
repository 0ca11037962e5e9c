"""One query for each operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from savormap.llm import (
    align_tokens,
    counts,
    exact,
    extract,
    lexicon,
    near,
    negatives,
    pack,
    passages,
    pii,
    quality,
    substrings,
    vectors,
)
from savormap.llm.common import documents, prepared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its own name."""

    def register(plan):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(prepared(spark), sf_dir)

        QUERIES[plan.__name__] = run
        if sql:
            SQL[plan.__name__] = sql
        return plan

    return register


@query()
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return lexicon.round_trip(documents(spark, sf_dir))


@query(
    """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """
)
def op4_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of equal texts stays, for every document."""
    return exact.copies(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query()
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = pii.find(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        *(pii.count_of(k, F.col("spans")).alias(f"n_{k}") for k in pii.BASE),
        F.sha2(pii.listed(pii.base_only(F.col("spans"))).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query()
def op7_packed_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and the sequences that hold them."""
    return pack.pack(documents(spark, sf_dir)).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return counts.token_counts(documents(spark, sf_dir))


@query()
def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels that are not held out."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.scores(docs, quality.trained(docs, labels))


@query(
    """
    WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                         WHERE list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
    pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
              ON a.vec_id != b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
    reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
    least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
    links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
           vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
    FROM embeddings LEFT JOIN links ON links.a = vec_id LEFT JOIN least ON least.a = vec_id
    """
)
def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.95."""
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query()
def op3_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document, and which of them stays."""
    return near.near_documents(documents(spark, sf_dir))


@query(
    """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT doc_id, unnest(generate_series(0, length(h) // 2 - 50)) AS i, h FROM d WHERE length(h) >= 100),
    s AS (SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS w FROM w),
    r AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) < doc_id AS again FROM s),
    b AS (SELECT doc_id, unnest(generate_series(0, length(h) // 2 - 1)) AS i, h FROM d),
    c AS (SELECT b.doc_id, b.i, substring(h, 2 * b.i + 1, 2) AS x,
                 coalesce(bool_or(again) OVER (PARTITION BY b.doc_id ORDER BY b.i
                          ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
          FROM b LEFT JOIN r ON b.doc_id = r.doc_id AND b.i = r.i),
    e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM c),
    k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
                 string_agg(CASE WHEN gone THEN '' ELSE x END, '' ORDER BY i) AS kept FROM e GROUP BY doc_id)
    SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)
    """
)
def op2_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 50 bytes."""
    return substrings.without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    r"""
    WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x != '') AS l
               FROM documents),
    w AS (SELECT doc_id, unnest(generate_series(1, len(l) - 49)) AS i, l FROM d WHERE len(l) >= 50),
    s AS (SELECT doc_id, i, array_to_string(l[i : i + 49], ' ') AS w FROM w),
    r AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) < doc_id AS again FROM s),
    b AS (SELECT doc_id, unnest(generate_series(1, len(l))) AS i, l FROM d),
    c AS (SELECT b.doc_id, b.i, l[b.i] AS x,
                 coalesce(bool_or(again) OVER (PARTITION BY b.doc_id ORDER BY b.i
                          ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
          FROM b LEFT JOIN r ON b.doc_id = r.doc_id AND b.i = r.i),
    k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
                 string_agg(CASE WHEN NOT gone THEN x END, ' ' ORDER BY i) AS kept FROM c GROUP BY doc_id)
    SELECT d.doc_id, len(l) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)
    """
)
def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated windows of 50 words."""
    return passages.without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query()
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers cover the same bytes, for every document."""
    return align_tokens.alignment(documents(spark, sf_dir))


@query(
    """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                 list_dot_product(a.e, b.e)::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id != b.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
                 row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
          FROM p JOIN s USING (anchor_id)
          WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
    """
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score nearly as high as each anchor's positives."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(vectors, moved)
