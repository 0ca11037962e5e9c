"""Keeping hot groups apart: size checks, salting and lists in pages.

One key may hold a third of all rows. Nothing here drops or caps rows; a hot
group is cut into pages of bounded length that go to different tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from savormap.storage import cut_lineage

LIST_ROWS = 4_000  # entries of a page that is cut by rows
SMALL_ROWS = 10_000  # rows a side may have to be broadcast by hand
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the lower 33 bits


def fits_in(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than it needs to know."""
    return df.limit(rows + 1).count() <= rows


def salt_of(columns: Sequence[Column], salts: int | Column) -> Column:
    """A stable salt below ``salts`` taken from the row's own values."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts) if isinstance(salts, int) else salts)


def lookup_join(
    df: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner", rows: int = SMALL_ROWS
) -> DataFrame:
    """Join a lookup table: broadcast when its size is checked small, else shuffled.

    The check counts ``lookup``, so hand in a stored table, not a long plan.
    """
    small = fits_in(lookup, rows)
    return df.join(F.broadcast(lookup) if small else lookup, list(on), how)


def all_equal(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(
        lambda a, b: a & b, (left[one].eqNullSafe(right[other]) for one, other in pairs)
    )


def ranked(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], name: str) -> DataFrame:
    """Rows with their place in their group, from 0, under a total order.

    Rows are range-partitioned by group and order, so a row's place in the whole
    table is its place in its partition plus the sizes of the partitions before;
    the group's first place is taken off. A hot group lies in many partitions. The
    sorted rows are stored, since a second range sampling could cut them elsewhere.
    """
    order = [*[F.col(k) for k in keys], *order_by]
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    piece = F.shiftright("_at", _ROW_BITS)
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so the ordered window and the broadcast are bounded.
    offsets = (
        placed.groupBy(piece.alias("_piece"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_piece", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = (
        placed.withColumn("_piece", piece)
        .join(F.broadcast(offsets), "_piece")
        .withColumn(name, F.col("_before") + row)
        .drop("_piece", "_before", "_at")
    )
    pairs = [(k, f"_of_{k}") for k in keys]
    firsts = numbered.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.min(name).alias("_first"))
    joined = numbered.join(firsts, all_equal(numbered, firsts, pairs))
    return joined.withColumn(name, F.col(name) - F.col("_first")).drop("_first", *[n for _, n in pairs])


def running_sums(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], value: Column, name: str
) -> DataFrame:
    """Rows with the sum of ``value`` (a long) over the rows before them in their group, under a total order.

    As ``ranked``: rows are range-partitioned, each partition adds up on its own, and
    what lies before it comes from one row per partition. So a hot group's sums are
    made in many tasks. The partitions are stored, since a second range sampling could
    cut them elsewhere.
    """
    order = [*[F.col(k) for k in keys], *order_by]
    stored = cut_lineage(
        df.withColumn("_value", value.cast("long")).repartitionByRange(*order).withColumn("_piece", F.spark_partition_id())
    )
    inside = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so the ordered window and the broadcast are bounded.
    offsets = (
        stored.groupBy("_piece")
        .agg(F.sum("_value").alias("_size"))
        .select("_piece", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_before"))
    )
    placed = (
        stored.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_piece")
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_piece", "_before", "_inside", "_value")
    )
    pairs = [(k, f"_of_{k}") for k in keys]
    firsts = placed.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.min(name).alias("_first"))
    joined = placed.join(firsts, all_equal(placed, firsts, pairs))
    return joined.withColumn(name, F.col(name) - F.col("_first")).drop("_first", *[n for _, n in pairs])


def json_bytes(items: Sequence[str]) -> Column:
    """What an entry of these columns takes in a JSON list, with its comma."""
    return F.octet_length(F.to_json(F.struct(*items))) + 1


def bounded_lists(
    df: DataFrame,
    keys: Sequence[str],
    items: Sequence[str],
    list_name: str,
    limit: int,
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Sorted lists in pages of at most ``limit`` bytes of JSON: one row per (keys, part).

    A page holds the entries that begin in one half ``limit`` of their group's running
    sum of bytes, so it ends less than one entry beyond that half. It stays within
    ``limit`` as long as no single entry takes more than the other half; a wider one can't
    be cut here. Reading the pages of a group in turn gives its whole list in order; parts
    may skip numbers where an entry is wider than a half.
    """
    order_by = list(order_by or [F.col(i) for i in items])
    placed = running_sums(df, keys, order_by, json_bytes(items), "_bytes")
    paged = placed.withColumn("part", F.floor(F.col("_bytes") / F.lit(max(1, limit // 2))).cast("long"))
    return sorted_lists(paged, [*keys, "part"], items, list_name, order_by)


def sorted_lists(
    df: DataFrame,
    keys: Sequence[str],
    items: Sequence[str],
    list_name: str,
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per group with a sorted array of structs; for groups an earlier step has bounded."""
    order_by = list(order_by or [F.col(i) for i in items])
    ordering = [o.alias(f"_o{n}") for n, o in enumerate(order_by)]
    entry = F.struct(*ordering, F.struct(*items).alias("entry"))
    return (
        df.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
        .withColumn(list_name, F.transform("_entries", lambda e: e["entry"]))
        .drop("_entries")
    )


def gather_lists(
    df: DataFrame,
    keys: Sequence[str],
    items: Sequence[str],
    list_name: str,
    order_by: Sequence[Column] | None = None,
    rows: int = LIST_ROWS,
) -> DataFrame:
    """Sorted lists of groups that nothing bounds, in pages: one row per (keys, part).

    Page ``part`` holds the entries from ``part * rows`` on, so reading the pages of
    a group in turn gives its whole list in order. All groups are treated alike; one
    of at most ``rows`` entries has page 0 alone.
    """
    order_by = list(order_by or [F.col(i) for i in items])
    paged = ranked(df, keys, order_by, "_rank").withColumn("part", F.floor(F.col("_rank") / F.lit(rows)).cast("long"))
    return sorted_lists(paged, [*keys, "part"], items, list_name, order_by)
