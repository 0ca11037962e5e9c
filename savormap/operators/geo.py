"""Places within a radius, their details, and the messages that carry them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from savormap.functions.geo import bounding_box, degrees_spanned, distance_km
from savormap.operators.shaping import known_rows
from savormap.skew import bounded_lists, gather_lists, salt_of
from savormap.storage import cut_lineage

# Details of a place in a message.
PLACE_DETAILS = ("name", "address", "dist_km", "latitude", "longitude", "stars", "hours")
CELL_DEGREES, CELL_BITS, FINEST = 16.0, 2, 4  # of the largest cells; each level has 4 x 4 in one
FIRST = 2  # the level of one degree, down to which a request names cells without having met the tree
CELL_ROWS = 4_096  # places of a cell that isn't cut further
MESSAGE_BYTES = 4 * 1024 * 1024  # what a broker is set to take
PHOTO_BYTES = 64 * 1024  # of the photos that a message carries beside a place


def located(places: DataFrame) -> DataFrame:
    """Places with an id and both coordinates."""
    return known_rows(places, "place_id", "latitude", "longitude")


def within_radius(
    places: DataFrame, lat, lon, km, metric: str = "planar100", keep: Sequence[str] = ("place_id",)
) -> DataFrame:
    """Places strictly nearer than ``km`` to a point, with ``dist_km``; unordered."""
    here = F.col("latitude"), F.col("longitude")
    return (
        located(places)
        .where(bounding_box(*here, lat, lon, km, metric))
        .withColumn("dist_km", distance_km(*here, lat, lon, metric))
        .where(F.col("dist_km") < F.lit(km))
        .select(*keep, "dist_km")
    )


def nearest_first(df: DataFrame) -> DataFrame:
    """Ascending distance, ties by place; sort last, joins would undo it."""
    return df.orderBy("dist_km", "place_id")


def city_centre(places: DataFrame, city: str) -> DataFrame:
    """Mean latitude and longitude of a city's places, as one row."""
    return (
        known_rows(places.where(F.col("city") == city), "latitude", "longitude")
        .agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
    )


def around_city(
    places: DataFrame, city: str, km, metric: str = "planar100", keep=("place_id",)
) -> DataFrame:
    """All places within ``km`` of a city's centre; the centre is a scalar subquery."""
    centre = city_centre(places, city)
    lat, lon = centre.select("latitude").scalar(), centre.select("longitude").scalar()
    return within_radius(places, lat, lon, km, metric, keep)


def within_city(
    places: DataFrame, city: str, lat, lon, km, metric: str = "planar100", keep=("place_id",)
) -> DataFrame:
    """A city's places within ``km`` of a point."""
    return within_radius(places.where(F.col("city") == city), lat, lon, km, metric, keep)


def photo_lists(photos: DataFrame, rows: int | None = None, limit: int = PHOTO_BYTES) -> DataFrame:
    """Per place, pages of photo ids with their captions, by photo id; null captions stay beside their photo.

    Pages have at most ``limit`` bytes of JSON, or, if given, ``rows`` photos.
    """
    items, order = ["photo_id", "caption"], [F.col("photo_id")]
    if rows is None:
        return bounded_lists(photos, ["place_id"], items, "photos", limit, order)
    return gather_lists(photos, ["place_id"], items, "photos", order, rows)


def beside(found: DataFrame, pages: DataFrame) -> DataFrame:
    """Places in range, each once, with the first of their ``pages`` of photos; places without keep a null list.

    ``photo_pages`` says how many pages there are.
    """
    counts = pages.groupBy("place_id").agg(F.count(F.lit(1)).alias("photo_pages"))
    first = pages.where("part = 0").select("place_id", "photos").join(counts, "place_id")
    return found.join(first, "place_id", "left")


def with_photos(found: DataFrame, photos: DataFrame, rows: int | None = None, limit: int = PHOTO_BYTES) -> DataFrame:
    """Places in range with the first page of their photos; ``further_photos`` gives the rest."""
    return beside(found, all_photos(found, photos, rows, limit))


def further_photos(found: DataFrame, photos: DataFrame, rows: int | None = None, limit: int = PHOTO_BYTES) -> DataFrame:
    """Later pages of the photos of places in range: ``place_id, part, photos``, from part 1 on."""
    return all_photos(found, photos, rows, limit).where("part > 0")


def all_photos(found: DataFrame, photos: DataFrame, rows: int | None = None, limit: int = PHOTO_BYTES) -> DataFrame:
    """All pages of the photos of places in range: ``place_id, part, photos``."""
    return photo_lists(_photos_of(found, photos), rows, limit)


def _photos_of(found: DataFrame, photos: DataFrame) -> DataFrame:
    return photos.join(found.select("place_id").distinct(), "place_id", "left_semi")


def _finest(value: Column) -> Column:
    return F.floor(value / F.lit(CELL_DEGREES / (1 << CELL_BITS * FINEST))).cast("long")


def _around(finest: Column, level: int) -> Column:
    """Row or column of the cell of a level around a finest cell."""
    return F.shiftright(finest, CELL_BITS * (FINEST - level))


def _path(row: Column, column: Column) -> list[Column]:
    """The cells around a finest one, widest first."""
    return [
        F.struct(F.lit(n).alias("_level"), _around(row, n).alias("_row"), _around(column, n).alias("_column"))
        for n in range(FINEST + 1)
    ]


def place_cells(places: DataFrame, cell_rows: int = CELL_ROWS, by: Sequence[str] = ()) -> DataFrame:
    """Every finest cell with places in it, and the leaf of the tree that it lies in; stored.

    The globe is cut into cells of 16 degrees, and a cell of more than ``cell_rows`` places into
    4 x 4 smaller ones, down to a sixteenth of a degree. ``level`` names the leaf's size; a finest
    cell that is still crowded has its places spread over several ``salts``. With ``by``, such as the
    city, each value has a tree of its own, so cells stay wide where few places share the value.
    """
    fine = located(places).groupBy(
        *by, _finest(F.col("latitude")).alias("fine_row"), _finest(F.col("longitude")).alias("fine_column")
    ).agg(F.count(F.lit(1)).alias("n"))
    sides = {f"_{c}{n}": _around(F.col(f"fine_{c}"), n) for n in range(FINEST) for c in ("row", "column")}
    fine = fine.withColumns(sides)
    # Rows dealt out by the widest cell, at most 2**16 of each, stay there for the smaller ones.
    sums = {
        f"n{n}": F.sum("n").over(Window.partitionBy(*by, *list(sides)[: 2 * n + 2])) for n in range(FINEST)
    }
    level = F.lit(FINEST)
    for n in reversed(range(FINEST)):
        level = F.when(F.col(f"n{n}") <= cell_rows, F.lit(n)).otherwise(level)
    salts = F.when(F.col("level") == FINEST, F.ceil(F.col("n") / F.lit(cell_rows))).otherwise(F.lit(1))
    kept = fine.withColumns(sums).withColumn("level", level).withColumn("salts", salts.cast("long"))
    return cut_lineage(kept.select(*by, "fine_row", "fine_column", "level", "salts"))


def _touched(level: int, within: bool) -> Column:
    """Cells of a level that a request's box touches, or those of them within the cell it has met."""
    ends = []
    for low, high, parent in (("_south", "_north", "_row"), ("_west", "_east", "_column")):
        first, last = _around(F.col(low), level), _around(F.col(high), level)
        if within:
            bits = CELL_BITS * (level - FIRST)
            part = F.shiftleft(F.col(parent), bits)
            first, last = F.greatest(first, part), F.least(last, part + ((1 << bits) - 1))
        ends.append(F.sequence(first, last))
    cell = lambda r, c: F.struct(F.lit(level).alias("_level"), r.alias("_row"), c.alias("_column"))
    return F.flatten(F.transform(ends[0], lambda r: F.transform(ends[1], lambda c: cell(r, c))))


def cells_of_requests(requests: DataFrame, cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requests with every leaf that has places and touches their bounding box, one row each.

    A box first meets the tree's cells down to one degree. Where such a cell has been cut further,
    those of its parts that the box touches come in its place; empty cells are gone by then.
    """
    reach = degrees_spanned(F.col("km"), "planar100")
    ends = {
        name: _finest(F.col(c) + sign * reach)
        for c, sign, name in (
            ("center_lat", -1, "_south"), ("center_lat", 1, "_north"), ("center_lon", -1, "_west"), ("center_lon", 1, "_east")
        )
    }
    key = ["_level", "_row", "_column"]
    own_key = [*by, *key]
    nodes = (
        cells.withColumn("_cell", F.explode(F.slice(F.array(*_path(F.col("fine_row"), F.col("fine_column"))), 1, F.col("level") + 1)))
        .groupBy(*by, *[F.col(f"_cell.{k}").alias(k) for k in key])
        .agg(F.max("level").alias("deepest"), F.max("salts").alias("salts"))
    )
    begun = F.concat(*[_touched(n, False) for n in range(FIRST + 1)])
    met = (
        requests.withColumns(ends)
        .withColumn("_cell", F.explode(begun))
        .select("*", "_cell.*")
        .drop("_cell")
        .join(nodes.drop("salts"), own_key)
        .where(f"deepest = _level OR _level = {FIRST}")
    )
    further = F.concat(*[_touched(n, True) for n in range(FIRST + 1, FINEST + 1)])
    own = F.array(F.struct(*key))
    leaves = (
        met.withColumn("_cell", F.explode(F.when(F.col("deepest") == F.col("_level"), own).otherwise(further)))
        .drop(*key, "deepest", *ends)
        .select("*", "_cell.*")
        .drop("_cell")
    )
    return leaves.join(nodes, own_key).where("deepest = _level").drop("deepest")


def range_join(
    places: DataFrame,
    requests: DataFrame,
    cell_rows: int = CELL_ROWS,
    same_city: bool = False,
) -> DataFrame:
    """Places in range of many centres at once, under the planar metric.

    ``requests`` holds request_id, user_id, center_lat, center_lon, km (and city). Both sides
    meet in the leaves of a tree of cells that is deep where places crowd, an equi-join, and the
    exact distance decides. So a request is copied a few times over thinly settled land however
    far it reaches, and only a finest cell of more than ``cell_rows`` places takes several tasks.
    With ``same_city`` each city has a tree of its own.
    """
    by = ["city"] if same_city else []
    if not same_city:
        requests = requests.drop("city")
    cells = place_cells(places, cell_rows, by)
    asked = cells_of_requests(requests, cells, by).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
    ).drop("salts")
    path = F.array(*_path(F.col("fine_row"), F.col("fine_column")))
    own = cells.withColumn("_cell", F.element_at(path, F.col("level") + 1)).select(*by, "fine_row", "fine_column", "salts", "_cell.*")
    placed = (
        located(places)
        .withColumns({"fine_row": _finest(F.col("latitude")), "fine_column": _finest(F.col("longitude"))})
        .join(own, [*by, "fine_row", "fine_column"])
        .withColumn("_salt", salt_of([F.col("place_id")], F.col("salts")))
        .drop("fine_row", "fine_column", "salts")
    )
    keys = ["_level", "_row", "_column", "_salt", *by]
    dist = distance_km(
        F.col("latitude"), F.col("longitude"), F.col("center_lat"), F.col("center_lon")
    )
    return (
        placed.join(asked, keys)
        .withColumn("dist_km", dist)
        .where(F.col("dist_km") < F.col("km"))
        .drop("_level", "_row", "_column", "_salt", "center_lat", "center_lon", "km")
    )


def range_messages(
    found: DataFrame, rows: int | None = None, place: str = "place_id", limit: int = MESSAGE_BYTES
) -> DataFrame:
    """Typed messages of each request: the user and a page of the places in range, nearest first.

    A message has at most ``limit`` bytes of JSON, or, if given, ``rows`` places. A longer
    list continues in further messages of the same user, in order. An entry is a
    place's details and one page of its photos at most, so it is far below ``limit``.
    """
    keys, name = ["request_id", "user_id"], "business_id_listInRange"
    items = [c for c in found.columns if c not in keys]
    order = [F.col("dist_km"), F.col(place)]
    if rows is None:
        # Half a kilobyte is for the user and the names around the list.
        lists = bounded_lists(found, keys, items, name, limit - 512, order)
    else:
        lists = gather_lists(found, keys, items, name, order, rows)
    return lists.select(*keys, "part", name)


def reviews_in_range(reviews: DataFrame, found: DataFrame, on: str = "place_id") -> DataFrame:
    """Reviews of the places in range; a review appears once however often its place was found."""
    return reviews.join(found.select(on), on, "left_semi")
