"""Buckets in bounded pieces: comparing what shares a bucket without emitting its pairs.

A bucket of more rows than a block is cut into parts that meet in pairs, each pair
a cell of its own; other buckets are one cell. So no task holds more than two
parts at once, and every pair of a bucket meets in exactly one cell.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savormap.storage import cut_lineage

CELL = ("bucket", "i", "j")


def celled(entries: DataFrame, block: int) -> DataFrame:
    """Entries (``bucket, node`` and more) with ``side`` and the cells ``i, j`` they meet in."""
    large = cut_lineage(
        entries.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > block)
        .select("bucket", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    return (
        entries.join(large, "bucket", "left")
        .withColumn("side", F.pmod(F.xxhash64("node"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("i", F.least("side", "other"))
        .withColumn("j", F.greatest("side", "other"))
        .drop("other", "parts")
    )


def by_cell(rows: DataFrame) -> DataFrame:
    """Each cell in one partition, its rows together."""
    return rows.repartition(*CELL).sortWithinPartitions(*CELL)


def groups(batches: Iterable[pa.RecordBatch], by: Sequence[str] = CELL) -> Iterator[pa.Table]:
    """One table for each value of ``by``, from batches in that order."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> Iterator[pa.Table]:
        keys = [table[c].to_numpy() for c in by]
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        ends = [0, *new.tolist(), table.num_rows]
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield table.slice(a, b - a)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        *whole, last = cut(pa.Table.from_batches(held))
        yield from whole
        held = last.combine_chunks().to_batches()
    if held:
        yield from cut(pa.Table.from_batches(held))


def across(table: pa.Table) -> bool:
    """Whether the cell holds two parts; then only pairs between them count."""
    return table["i"][0].as_py() != table["j"][0].as_py()
