"""What the corpus operators share: settings, columns and bounded summaries."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 1_024
BATCH_BYTES = 3 * 1024 * 1024


def prepared(spark: SparkSession) -> SparkSession:
    """Arrow batches bounded in rows and bytes, so that very long texts don't pile up in a worker."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table of documents."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text is empty. Further columns don't matter."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))


def text_of(docs: DataFrame) -> Column:
    """The text column, a null being empty."""
    return F.coalesce(docs["text"], F.lit(""))


def fresh(df: DataFrame, label: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{label}"
    while name in taken:
        name = f"_{label}_{uuid.uuid4().hex[:8]}"
    return name


def shrink(counts: Counter, keep: int) -> Counter:
    """Misra-Gries: at most ``keep`` counters, all lowered by the largest count that goes."""
    if len(counts) <= keep:
        return counts
    floor = sorted(counts.values(), reverse=True)[keep]
    return Counter({k: c - floor for k, c in counts.items() if c > floor})


def summary(items: Iterable[list], keep: int, longest: int | None = None) -> tuple[Counter, int]:
    """Misra-Gries counters of all items, ``keep`` at most, and the number of items.

    A count is too low by at most items / keep and never too high. Items longer
    than ``longest`` are not kept.
    """
    counts, total = Counter(), 0
    for some in items:
        total += len(some)
        counts.update([i for i in some if len(i) <= longest] if longest else some)
        if len(counts) > 4 * keep:
            counts = shrink(counts, keep)
    return shrink(counts, keep), total
