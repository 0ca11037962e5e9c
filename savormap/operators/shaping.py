"""Row shaping: filters, deduplication, dense indexes, splits, explode."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from savormap.storage import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the lower 33 bits
_SPLIT_STEPS = 1_000_000


def known_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where none of ``columns`` is null."""
    return df.where(reduce(and_, (F.col(c).isNotNull() for c in columns)))


def stars_above(df: DataFrame, column: str = "stars", limit: float = 4.0) -> DataFrame:
    """Rows whose ``column`` reads as a float strictly above ``limit``."""
    return df.withColumn(column, F.col(column).try_cast("float")).where(F.col(column) > limit)


def one_per_text(
    df: DataFrame, text: str, key: str, keep: Sequence[str], digest: bool = True
) -> DataFrame:
    """One row per text, the one with the lowest ``key``; a row without a key only where no other has the text.

    Grouping by a 256-bit digest keeps long texts out of the shuffle, and the
    minimum is combined before it, so a text with very many copies is cheap.
    """
    group = F.unhex(F.sha2(F.col(text), 256)) if digest else F.col(text)
    rest = [c for c in keep if c != key]
    return (
        df.groupBy(group.alias("_text"))
        .agg(F.min(F.struct(F.col(key).isNull().alias("_keyless"), key, *rest)).alias("_first"))
        .select(*[F.col("_first")[c].alias(c) for c in keep])
    )


def dense_index(df: DataFrame, id_column: str, index_column: str) -> DataFrame:
    """Number the distinct ids 0..n-1 in id order.

    Ids are range-partitioned and sorted, so a row's index is its position in
    its partition plus the sizes of the partitions before it. No step sees more
    than one partition. The sorted ids are stored, because a second run of the
    range sampling could cut them elsewhere.
    """
    ids = known_rows(df.select(id_column), id_column).distinct()
    placed = cut_lineage(
        ids.repartitionByRange(id_column)
        .sortWithinPartitions(id_column)
        .withColumn("_at", F.monotonically_increasing_id())
    ).select(
        id_column,
        F.shiftright("_at", _ROW_BITS).alias("_slice"),
        F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    # One row per partition, so the ordered window and the broadcast are bounded.
    offsets = (
        placed.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    return placed.join(F.broadcast(offsets), "_slice").select(
        id_column, (F.col("_before") + F.col("_row")).alias(index_column)
    )


def extend_index(known: DataFrame, df: DataFrame, id_column: str, index_column: str) -> DataFrame:
    """The index ``known`` with the ids of ``df`` that it lacks, numbered on from its largest number.

    Old numbers stay, so what was fitted or stored by them remains valid. The new ids are
    numbered in id order among themselves. Only they are sorted; the largest number is a
    scalar subquery.
    """
    new = known_rows(df.select(id_column), id_column).distinct().join(known.select(id_column), id_column, "left_anti")
    first = known.agg(F.coalesce(F.max(index_column) + 1, F.lit(0).cast("long")).alias("_first")).scalar()
    added = dense_index(new, id_column, index_column).withColumn(index_column, F.col(index_column) + first)
    return known.select(id_column, index_column).unionByName(added)


def split_fraction(keys: Sequence[str], seed: int = 42) -> Column:
    """A number in [0, 1) fixed by the row's keys and the seed."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return F.pmod(draw, F.lit(_SPLIT_STEPS)) / F.lit(float(_SPLIT_STEPS))


def split_rows(
    df: DataFrame, keys: Sequence[str], first: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together hold every row; the same rows on every run."""
    draw = split_fraction(keys, seed)
    return df.where(draw < first), df.where(draw >= first)


def unnest(df: DataFrame, array: str, *carry: str) -> DataFrame:
    """One row per element of an array of structs, next to the carried columns."""
    return df.select(*carry, F.explode(array).alias("_e")).select(*carry, "_e.*")


def well_starred(
    places: Column, place: str = "place_id", stars: str = "stars", limit: float = 4.0
) -> Column:
    """Ids of a list's places with more than ``limit`` stars, worked out inside the row."""
    good = F.filter(places, lambda p: p[stars].try_cast("float") > limit)
    return F.transform(good, lambda p: p[place])
