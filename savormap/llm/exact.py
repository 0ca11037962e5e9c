"""Exact deduplication with a heavy-hitter split.

Misra-Gries counters over every digest find the frequent ones; their exact
counts and winners are taken in one more pass over the stored digests and
broadcast, so rows of frequent texts never leave their map task. The remaining
digests are grouped by ordinary shuffling.

Texts are equal when identical; a null text is the empty text. Of equal texts
the row with the largest ``doc_id`` stays; a null ``doc_id`` is smaller than any
other. Of rows equal in both, exactly one stays. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from savormap.llm.common import fresh, summary, text_of
from savormap.storage import cut_lineage

COUNTERS = 4_096  # bounds the broadcast: so many winners of about 60 bytes


def digest_of(docs: DataFrame) -> Column:
    """SHA-256 of the text in UTF-8."""
    return F.unhex(F.sha2(text_of(docs).cast("binary"), 256))


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them each one with more than 3/counters of all rows.

    A partition sends only counts above its rows / counters; counts of the same
    digest are added up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = summary((b.column(0).to_pylist() for b in batches), counters)
        large = [(d, c) for d, c in counts.items() if c > max(1, total // counters)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in large], pa.binary()), pa.array([c for _, c in large], pa.int64())],
            ["digest", "n"],
        )

    return (
        digests.select("digest")
        .mapInArrow(count, "digest binary, n long")
        .groupBy("digest")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "digest")
        .limit(counters)
        .select("digest")
    )


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row")).alias("winner"), F.count(F.lit(1)).alias("group_size")
    )


def winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Exact winner and size of each frequent digest: ``digest, winner, group_size``; stored."""
    few = cut_lineage(frequent(digests, counters))
    return cut_lineage(_groups(digests.join(F.broadcast(few), "digest", "left_semi")))


def stored_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, row`` of every row, stored; ``row`` tells equal rows apart."""
    return cut_lineage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            digest_of(docs).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``doc_id, digest, keep_id, group_size, kept`` of every row, dropped ones too."""
    digests = stored_digests(docs)
    heavy = winners(digests, counters)
    marked = digests.join(F.broadcast(heavy), "digest", "left")
    light = marked.where("group_size is null").select("doc_id", "digest", "row")
    shuffled = light.join(_groups(light), "digest")
    rows = marked.where("group_size is not null").unionByName(shuffled)
    return rows.select(
        "doc_id",
        "digest",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("winner.row") == F.col("row")).alias("kept"),
    )


def without_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with the columns of ``docs``.

    Frequent texts lose all but their winners map-side; each task then passes on
    one row per text, and those meet in a shuffle by digest.
    """
    heavy = winners(stored_digests(docs), counters).select("digest", F.col("winner.doc_id").alias("id"))
    key, rank = fresh(docs, "digest"), fresh(docs, "rank")
    keyed = docs.withColumn(key, digest_of(docs))
    few = F.broadcast(heavy)
    passed = keyed.join(few, keyed[key] == few["digest"], "left").where(
        few["digest"].isNull() | keyed["doc_id"].eqNullSafe(few["id"])
    )
    order = Window.partitionBy(keyed[key]).orderBy(keyed["doc_id"].desc_nulls_last())
    return (
        passed.select(*[keyed[c] for c in keyed.columns], F.row_number().over(order).alias(rank))
        .where(F.col(rank) == 1)
        .select(*docs.columns)
    )
