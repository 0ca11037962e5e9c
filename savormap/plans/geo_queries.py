"""Places within a radius, their photos, and range messages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from savormap.functions.geo import haversine, planar100, wkt_latitude, wkt_longitude, wkt_point
from savormap.operators import geo
from savormap.operators.metrics import summary_statistics
from savormap.operators.range_lists import range_lists
from savormap.plans import views
from savormap.plans.registry import query
from savormap.plans.views import sql_over
from savormap.skew import LIST_ROWS, lookup_join
from savormap.sources import spatial
from savormap.storage import cut_lineage, scratch_path

LAT, LON, KM, CITY = 45.5, -122.5, 20.0, "NATION_3"
SMALL_MESSAGE, SMALL_PAGE = 8 * 1024, 1024  # bounds under which the lists of the tables take several pages

_DIST = "sqrt(pow(latitude - 45.5, 2) + pow(longitude + 122.5, 2)) * 100"
_NEAR = f"SELECT *, {_DIST} AS dist_km FROM places WHERE {_DIST} < 20"
_HAVERSINE = """2 * 6371.0088 * asin(least(1.0, sqrt(
    pow(sin(radians(latitude - 45.5) / 2), 2)
    + cos(radians(latitude)) * cos(radians(45.5)) * pow(sin(radians(longitude + 122.5) / 2), 2))))"""
_CENTRE = """, c AS (SELECT avg(latitude) AS lat0, avg(longitude) AS lon0 FROM places WHERE city = 'NATION_3'),
    d AS (SELECT place_id, city, sqrt(pow(latitude - lat0, 2) + pow(longitude - lon0, 2)) * 100 AS dist_km
          FROM places, c)"""


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "G1 J10 F-3 W4",
    sql_over("places", f"SELECT place_id, round(dist_km, 6) AS dist_km FROM ({_NEAR}) ORDER BY dist_km, place_id"),
)
def places_near_point(spark, sf):
    found = geo.within_radius(views.places(spark, sf), LAT, LON, KM)
    return _rounded(geo.nearest_first(found), "dist_km")


@query("G1 S2 F-3", sql_over("places", f"SELECT place_id, round(dist_km, 6) AS dist_km FROM ({_NEAR})"))
def stored_places_near_point(spark, sf):
    """The same places from a table laid out by zone, of which the radius reads a few folders."""
    path = scratch_path(spark, "places")
    spatial.write_places(views.places(spark, sf), path)
    return _rounded(geo.within_radius(spatial.read_places(spark, path, LAT, LON, KM), LAT, LON, KM), "dist_km")


@query(
    "W5 W4",
    sql_over(
        "places",
        f"SELECT place_id, round(dist_km, 6) AS dist_km FROM ({_NEAR}) ORDER BY {_DIST}, place_id LIMIT 10",
    ),
)
def ten_nearest_places(spark, sf):
    found = geo.within_radius(views.places(spark, sf), LAT, LON, KM)
    return _rounded(geo.nearest_first(found).limit(10), "dist_km")


@query(
    "F-3 G1",
    sql_over("places", f"SELECT place_id, round({_HAVERSINE}, 6) AS dist_km FROM places WHERE {_HAVERSINE} < 20"),
)
def places_near_point_great_circle(spark, sf):
    found = geo.within_radius(views.places(spark, sf), LAT, LON, KM, metric="haversine")
    return _rounded(found, "dist_km")


@query(
    "F-1 F-2",
    sql_over(
        "places",
        """SELECT place_id, 'POINT(' || CAST(latitude AS VARCHAR) || ' ' || CAST(longitude AS VARCHAR) || ')' AS location,
           latitude, longitude FROM places""",
    ),
)
def place_points(spark, sf):
    written = views.places(spark, sf).select(
        "place_id", wkt_point(F.col("latitude"), F.col("longitude")).alias("location")
    )
    return written.select(
        "place_id",
        "location",
        wkt_latitude(F.col("location")).alias("latitude"),
        wkt_longitude(F.col("location")).alias("longitude"),
    )


@query(
    "A1",
    sql_over(
        "places",
        "SELECT round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude FROM places WHERE city = 'NATION_3'",
    ),
)
def city_centre(spark, sf):
    return _rounded(geo.city_centre(views.places(spark, sf), CITY), "latitude", "longitude")


@query(
    "G2 A1 G1",
    sql_over("places", f"{_CENTRE} SELECT place_id, round(dist_km, 6) AS dist_km FROM d WHERE dist_km < 20"),
)
def places_around_city(spark, sf):
    return _rounded(geo.around_city(views.places(spark, sf), CITY, KM), "dist_km")


@query(
    "G3 P4",
    sql_over("places", f"SELECT place_id, round(dist_km, 6) AS dist_km FROM ({_NEAR}) WHERE city = 'NATION_3'"),
)
def places_within_city(spark, sf):
    return _rounded(geo.within_city(views.places(spark, sf), CITY, LAT, LON, KM), "dist_km")


@query("A2", sql_over("places", f"SELECT count(*) AS n FROM ({_NEAR})"))
def count_near_point(spark, sf):
    found = geo.within_radius(views.places(spark, sf), LAT, LON, KM)
    return found.agg(F.count(F.lit(1)).alias("n"))


@query(
    "A4",
    sql_over(
        "places",
        f"""SELECT count(dist_km) AS n, round(avg(dist_km), 6) AS mean, round(stddev_samp(dist_km), 6) AS stddev,
            round(min(dist_km), 6) AS min, round(max(dist_km), 6) AS max FROM ({_NEAR})""",
    ),
)
def distance_summary(spark, sf):
    found = geo.within_radius(views.places(spark, sf), LAT, LON, KM)
    return _rounded(summary_statistics(found, "dist_km"), "mean", "stddev", "min", "max")


_PHOTO_ROWS = "photo_id, caption"


@query("A3", sql_over("photos", f"""SELECT place_id, (row_number() OVER w - 1) // 4000 AS part, (row_number() OVER w - 1) % 4000 AS pos, {_PHOTO_ROWS}
         FROM photos WINDOW w AS (PARTITION BY place_id ORDER BY photo_id)"""))
def photo_list_entries(spark, sf):
    lists = geo.photo_lists(views.photos(spark, sf), rows=LIST_ROWS)
    listed = lists.select("place_id", "part", F.posexplode("photos"))
    return listed.select("place_id", "part", F.col("pos").cast("long").alias("pos"), "col.photo_id", "col.caption")


@query("A3", sql_over("photos", f"""SELECT place_id, (row_number() OVER w - 1) // 3 AS part, (row_number() OVER w - 1) % 3 AS pos, {_PHOTO_ROWS}
         FROM photos WINDOW w AS (PARTITION BY place_id ORDER BY photo_id)"""))
def photo_pages(spark, sf):
    """Pages of three photos, so that most places have several."""
    lists = geo.photo_lists(views.photos(spark, sf), rows=3)
    listed = lists.select("place_id", "part", F.posexplode("photos"))
    return listed.select("place_id", "part", F.col("pos").cast("long").alias("pos"), "col.photo_id", "col.caption")


@query(
    "G5 F-10",
    sql_over(
        "found",
        """SELECT request_id, (row_number() OVER w - 1) // 4 AS page, (row_number() OVER w - 1) % 4 AS pos, place_id
           FROM found WINDOW w AS (PARTITION BY request_id ORDER BY dist_km, place_id)""",
    ),
)
def range_message_pages(spark, sf):
    """Messages of four places each, continued in order."""
    places = views.places(spark, sf).select("place_id", "city", "latitude", "longitude")
    messages = range_lists(places, views.requests(spark, sf), ["place_id", "dist_km"], same_city=True, rows=4)
    listed = messages.select("request_id", F.col("part").alias("page"), F.posexplode("business_id_listInRange"))
    return listed.select("request_id", "page", F.col("pos").cast("long").alias("pos"), "col.place_id")


@query(
    "G4 J1 J2 A3",
    sql_over(
        "places photos",
        f"""SELECT n.place_id, name, address, round(dist_km, 6) AS dist_km, latitude, longitude, stars, hours,
              count(photo_id) OVER (PARTITION BY n.place_id) AS n_photos,
              CASE WHEN photo_id IS NOT NULL THEN row_number() OVER (PARTITION BY n.place_id ORDER BY photo_id) - 1 END AS pos,
              photo_id, caption
            FROM ({_NEAR}) n LEFT JOIN photos USING (place_id) WHERE city = 'NATION_3'""",
    ),
)
def places_with_photos(spark, sf):
    """A row for each photo, in the order of its place's pages; a place without photos has one row."""
    keep = ["place_id", *[c for c in geo.PLACE_DETAILS if c != "dist_km"]]
    found = cut_lineage(geo.within_city(views.places(spark, sf), CITY, LAT, LON, KM, keep=keep))
    pages = cut_lineage(geo.all_photos(found, views.photos(spark, sf), limit=SMALL_PAGE))
    # One row per page, so the window over a place's pages is far shorter than its list.
    sizes = pages.select("place_id", "part", F.size("photos").cast("long").alias("n"))
    place = Window.partitionBy("place_id")
    ahead = place.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = sizes.select(
        "place_id",
        "part",
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_before"),
        F.sum("n").over(place).alias("n_photos"),
    )
    photos = pages.join(counted, ["place_id", "part"]).select(
        "place_id", "n_photos", "_before", F.posexplode("photos").alias("_at", "photo")
    )
    return found.join(photos, "place_id", "left").select(
        "place_id",
        *[F.round(c, 6).alias(c) if c == "dist_km" else c for c in geo.PLACE_DETAILS],
        F.coalesce("n_photos", F.lit(0)).cast("long").alias("n_photos"),
        (F.col("_before") + F.col("_at")).cast("long").alias("pos"),
        "photo.photo_id",
        "photo.caption",
    )


@query(
    "G3",
    sql_over("found", "SELECT request_id, place_id, round(dist_km, 6) AS dist_km FROM found"),
)
def places_of_all_requests(spark, sf):
    found = geo.range_join(views.places(spark, sf), views.requests(spark, sf), same_city=True)
    return _rounded(found.select("request_id", "place_id", "dist_km"), "dist_km")


def _messages(spark, sf, limit=geo.MESSAGE_BYTES, photo_limit=geo.PHOTO_BYTES):
    """Range messages of all requests, and all pages of the photos; photos join places before these join requests."""
    places = views.places(spark, sf)
    pages = cut_lineage(geo.all_photos(geo.located(places), views.photos(spark, sf), limit=photo_limit))
    listed = cut_lineage(geo.beside(places, pages).drop("photo_pages"))
    items = ["place_id", *[c for c in geo.PLACE_DETAILS if c != "dist_km"], "dist_km", "photos"]
    return range_lists(listed, views.requests(spark, sf), items, same_city=True, limit=limit), pages


def range_message_rows(spark, sf):
    """Range messages of all requests."""
    return _messages(spark, sf)[0].drop("ahead", "n_places")


@query(
    "F-10 G5 K2",
    sql_over(
        "found",
        """ SELECT request_id, user_id, row_number() OVER (PARTITION BY request_id ORDER BY dist_km, place_id) - 1 AS pos,
          place_id, true AS fits, count(*) OVER (PARTITION BY request_id) AS n_places FROM found""",
    ),
)
def entries_of_small_messages(spark, sf):
    """Messages bounded by few bytes: within the bound, and in turn the whole list in order."""
    messages = _messages(spark, sf, SMALL_MESSAGE, SMALL_PAGE)[0]
    value = F.to_json(F.struct("user_id", "business_id_listInRange"))
    entries = messages.withColumn("fits", F.octet_length(value) <= SMALL_MESSAGE).select(
        "request_id", "user_id", "ahead", "fits", "n_places", F.posexplode("business_id_listInRange").alias("_at", "entry")
    )
    return entries.select(
        "request_id",
        "user_id",
        (F.col("ahead") + F.col("_at")).cast("long").alias("pos"),
        F.col("entry.place_id").alias("place_id"),
        "fits",
        "n_places",
    )


@query(
    "G5 F-8 F-9 F-10 P13",
    sql_over(
        "found photos",
        """, p AS (SELECT place_id, count(*) AS n_photos FROM photos GROUP BY place_id)
        SELECT request_id, user_id, row_number() OVER (PARTITION BY request_id ORDER BY dist_km, place_id) - 1 AS pos,
          place_id, name, stars, round(dist_km, 6) AS dist_km, coalesce(n_photos, 0) AS n_photos
        FROM found LEFT JOIN p USING (place_id)""",
    ),
)
def range_message_entries(spark, sf):
    messages, pages = _messages(spark, sf)
    as_json = messages.withColumn("value", F.to_json(F.struct("user_id", "business_id_listInRange")))
    parsed = as_json.select(
        "request_id",
        "ahead",
        F.from_json("value", messages.select("user_id", "business_id_listInRange").schema).alias("m"),
    ).select("request_id", "ahead", "m.user_id", F.posexplode("m.business_id_listInRange"))
    # Most often few places have further pages, so entries needn't be shuffled to them.
    more = cut_lineage(pages.where("part > 0").groupBy("place_id").agg(F.sum(F.size("photos")).alias("_more")))
    entries = parsed.select(
        "request_id",
        "user_id",
        (F.col("ahead") + F.col("pos")).cast("long").alias("pos"),
        "col.place_id",
        "col.name",
        "col.stars",
        F.round("col.dist_km", 6).alias("dist_km"),
        F.coalesce(F.size("col.photos"), F.lit(0)).cast("long").alias("_shown"),
    )
    n_photos = F.col("_shown") + F.coalesce("_more", F.lit(0))
    return lookup_join(entries, more, ["place_id"], "left").withColumn("n_photos", n_photos).drop("_shown", "_more")


@query(
    "G6 J3 A2",
    sql_over(
        "ratings places",
        f"{_CENTRE} SELECT user_id, item_id, stars, ts FROM ratings WHERE user_id IN (SELECT place_id FROM d WHERE dist_km < 20)",
    ),
)
def ratings_around_city(spark, sf):
    near = geo.around_city(views.places(spark, sf), CITY, KM)
    rated = views.ratings(spark, sf).select("user_id", "item_id", "stars", "ts")
    return geo.reviews_in_range(
        rated, near.withColumnRenamed("place_id", "user_id"), on="user_id"
    )


@query(
    "F-1 F-3",
    sql_over("places", f"SELECT place_id, round({_HAVERSINE}, 6) AS great_circle, round({_DIST}, 6) AS planar FROM places"),
)
def both_distances(spark, sf):
    here = F.col("latitude"), F.col("longitude")
    return views.places(spark, sf).select(
        "place_id",
        F.round(haversine(*here, LAT, LON), 6).alias("great_circle"),
        F.round(planar100(*here, LAT, LON), 6).alias("planar"),
    )
