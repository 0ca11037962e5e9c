"""Places stored by where they are, so that a radius reads few files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from savormap.functions.geo import bounding_box, degrees_spanned
from savormap.operators.shaping import known_rows

ZONE_DEGREES = 4.0  # so at most 45 by 90 zones on the globe
ROW, COLUMN = "latitude_zone", "longitude_zone"
RECORDS_PER_FILE = 1_000_000
_STEPS = 1 << 16  # of a coordinate's range


def _spread(value: Column) -> Column:
    """The lowest 16 bits with a zero before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return value


def interleaved(latitude: Column, longitude: Column) -> Column:
    """The bits of both coordinates in turn: points near in this order are near in both."""

    def steps(value: Column, least: float, span: float) -> Column:
        step = F.floor((value - F.lit(least)) / F.lit(span) * F.lit(_STEPS)).cast("long")
        return F.greatest(F.lit(0).cast("long"), F.least(step, F.lit(_STEPS - 1).cast("long")))

    return _spread(steps(latitude, -90.0, 180.0)).bitwiseOR(F.shiftleft(_spread(steps(longitude, -180.0, 360.0)), 1))


def _zone(value: Column) -> Column:
    return F.floor(value / F.lit(ZONE_DEGREES)).cast("int")


def write_places(places: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Places with both coordinates, in a folder per zone and in the order of interleaved bits inside it.

    The rows are range-partitioned by that order, so a crowded zone lies in many tasks and files, each
    of a small area. Rows without an id or a coordinate can't be in any range and are left out.
    """
    zones = [_zone(F.col(c)) for c in ("latitude", "longitude")]
    placed = known_rows(places, "place_id", "latitude", "longitude").select(
        "*", zones[0].alias(ROW), zones[1].alias(COLUMN), interleaved(F.col("latitude"), F.col("longitude")).alias("_order")
    )
    order = [ROW, COLUMN, "_order"]
    (
        placed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_order")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", records_per_file)
        .partitionBy(ROW, COLUMN)
        .parquet(path)
    )


def read_places(spark: SparkSession, path: str, lat: float, lon: float, km: float, metric: str = "planar100") -> DataFrame:
    """The stored places that may lie within ``km`` of a point, for ``within_radius`` to decide on.

    Folders of zones that the circle's box doesn't touch aren't listed for reading; in those it does,
    the box goes to the scan, and the order of the rows lets it skip files and row groups.
    """
    stored = spark.read.parquet(path)
    reach = degrees_spanned(float(km), metric)
    sides = [(ROW, lat)] + ([(COLUMN, lon)] if metric == "planar100" else [])
    within = reduce(
        lambda a, b: a & b,
        (F.col(zone).between(_zone(F.lit(float(at)) - reach), _zone(F.lit(float(at)) + reach)) for zone, at in sides),
    )
    box = bounding_box(F.col("latitude"), F.col("longitude"), lat, lon, km, metric)
    return stored.where(within & box).drop(ROW, COLUMN)
