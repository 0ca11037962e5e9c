"""Text normalisation, vocabulary, label encoding and star ratings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from savormap.functions import text
from savormap.operators import classify
from savormap.plans import views
from savormap.plans.registry import query
from savormap.storage import cut_lineage, spread_if_small


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _expanded(column: str) -> str:
    for old, new in text.CONTRACTIONS:
        column = f"replace({column}, {_quoted(old)}, {_quoted(new)})"
    return column


def _blanked(column: str) -> str:
    for old in text.ESCAPES:
        column = f"replace({column}, {_quoted(old)}, ' ')"
    return column


def _tokens(column: str, rule: str = "list") -> str:
    cleaned = f"lower(regexp_replace({_blanked(_expanded(column))}, '[^A-Za-z]+', ' ', 'g'))"
    stop = ", ".join(_quoted(w) for w in text.STOP_WORDS)
    kept = {
        "list": f"NOT list_contains([{stop}], w)",
        "path": f"NOT contains({_quoted(text.STOP_PATH)}, w)",
    }[rule]
    return (
        f"list_filter(string_split({cleaned}, ' '), "
        f"lambda w: len(list_distinct(string_split(w, ''))) > 2 AND {kept})"
    )


def _normal(column: str, rule: str = "list") -> str:
    return f"array_to_string({_tokens(column, rule)}, ' ')"


@query(
    "F-14 F-15 F-16",
    f"""SELECT doc_id, {_expanded("text")} AS expanded, {_blanked("text")} AS blanked,
        regexp_replace(text, '[^A-Za-z]+', ' ', 'g') AS letters FROM documents""",
)
def cleaned_documents(spark, sf):
    body = F.col("text")
    return spread_if_small(views.table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id",
        text.expand_contractions(body).alias("expanded"),
        text.blank_escapes(body).alias("blanked"),
        text.letters_only(body).alias("letters"),
    )


@query(
    "M15 F-14 F-15 F-16 F-17 F-18 F-19",
    f"SELECT doc_id, {_normal('text')} AS text FROM documents",
)
def normal_documents(spark, sf):
    documents = spread_if_small(views.table(spark, sf, "documents").select("doc_id", "text"))
    return documents.select("doc_id", text.normal_text(F.col("text")).alias("text"))


@query(
    "M15 F-18",
    f"SELECT doc_id, {_normal('text', 'path')} AS text FROM documents",
)
def normal_documents_path_rule(spark, sf):
    documents = spread_if_small(views.table(spark, sf, "documents").select("doc_id", "text"))
    return documents.select("doc_id", text.normal_text(F.col("text"), "path").alias("text"))


@query(
    "M15 F-17",
    f"SELECT conv_id, turn, {_normal('text')} AS text FROM conversations",
)
def normal_conversations(spark, sf):
    turns = spread_if_small(views.table(spark, sf, "conversations"))
    return turns.select("conv_id", "turn", text.normal_text(F.col("text")).alias("text"))


def tokenised(spark, sf):
    """doc_id, lang and the normalised tokens."""
    documents = spread_if_small(views.table(spark, sf, "documents").select("doc_id", "lang", "text"))
    return documents.select("doc_id", "lang", text.normal_tokens(F.col("text")).alias("tokens"))


_VOCABULARY = f"""WITH t AS (SELECT doc_id, unnest({_tokens("text")}) AS word FROM documents),
    v AS (SELECT word, count(*) AS n FROM t GROUP BY word ORDER BY n DESC, word LIMIT 5999),
    ranked AS (SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS rank FROM v)"""


@query("M16", f"{_VOCABULARY} SELECT word, n, rank FROM ranked")
def document_vocabulary(spark, sf):
    return classify.vocabulary(tokenised(spark, sf))


@query("M16", f"{_VOCABULARY} SELECT DISTINCT doc_id, rank FROM t JOIN ranked USING (word)")
def document_word_ranks(spark, sf):
    words = cut_lineage(tokenised(spark, sf))
    return classify.multi_hot(words, classify.vocabulary(words), "doc_id")


@query(
    "M17",
    """WITH c AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS k FROM (SELECT DISTINCT lang FROM documents))
    SELECT doc_id, lang, CAST(k AS DOUBLE) AS label_idx,
      array_to_string(list_transform(range((SELECT count(*) FROM c)), lambda i: CASE WHEN i = k THEN '1' ELSE '0' END), '') AS label_vec
    FROM documents JOIN c USING (lang)""",
)
def encoded_labels(spark, sf):
    documents = views.table(spark, sf, "documents").select("doc_id", "lang")
    coded = classify.one_hot(documents, "lang")
    bits = F.array_join(F.transform("label_vec", lambda x: x.cast("int").cast("string")), "")
    return coded.withColumn("label_vec", bits)


_VOWELS = "aeiou"


def vowel_scorer(texts):
    """A stand-in for an outside model: five scores per text, the number of each vowel."""
    return np.array([[t.count(v) for v in _VOWELS] for t in texts], dtype=np.float64)


_COUNTS = ", ".join(f"len(text) - len(replace(text, '{v}', ''))" for v in _VOWELS)


@query(
    "M22 F-20",
    f"""WITH s AS (SELECT doc_id, [{_COUNTS}] AS scores FROM documents)
    SELECT doc_id, CAST(list_position(scores, list_max(scores)) AS INTEGER) AS stars FROM s""",
)
def document_stars(spark, sf):
    documents = spread_if_small(views.table(spark, sf, "documents").select("doc_id", "text"))
    return classify.star_ratings(documents, vowel_scorer).select("doc_id", "stars")
