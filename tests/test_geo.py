"""Radius selection, photo lists, range joins and messages."""

import random

import pytest
from pyspark.sql import functions as F

from savormap.functions.geo import distance_km, wkt_latitude, wkt_longitude
from savormap.operators import geo
from savormap.plans import geo_queries
from savormap.skew import running_sums
from savormap.sources import spatial
from tests.conftest import plan_of

PLACES = "place_id long, name string, address string, city string, latitude double, longitude double, stars double, hours string"


def place(key, lat, lon, city="A"):
    return key, f"p{key}", "street", city, lat, lon, 4.5, None


@pytest.fixture(scope="module")
def scattered(spark):
    rng = random.Random(7)
    rows = [place(i, rng.uniform(-90, 90), rng.uniform(-180, 180), "AB"[i % 2]) for i in range(3000)]
    rows += [place(3000 + i, 45 + rng.gauss(0, 0.2), -122 + rng.gauss(0, 0.2)) for i in range(1500)]
    return spark.createDataFrame(rows, PLACES).repartition(8).cache()


def ids(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or ("place_id",))).collect())


def test_edge_and_missing_coordinates(spark):
    places = spark.createDataFrame(
        [place(1, 45.0, -122.0), place(2, 45.2, -122.0), place(3, None, -122.0), place(4, 45.1, -122.0)],
        PLACES,
    )
    edge = geo.within_radius(places, 45.0, -122.0, 25.0)
    assert ids(edge) == [(1,), (2,), (4,)]
    on_it = places.where("place_id = 2").select(distance_km(F.col("latitude"), F.col("longitude"), 45.0, -122.0).alias("d")).first()["d"]
    assert (2,) not in ids(geo.within_radius(places, 45.0, -122.0, on_it))


@pytest.mark.parametrize("metric", ["planar100", "haversine"])
@pytest.mark.parametrize("centre", [(45.0, -122.0, 30.0), (0.0, 179.9, 2500.0), (89.0, 10.0, 1500.0), (-60.0, -179.0, 4000.0), (10.0, 0.0, 12000.0)])
def test_box_loses_nothing(scattered, metric, centre):
    lat, lon, km = centre
    here = F.col("latitude"), F.col("longitude")
    plain = scattered.where(distance_km(*here, lat, lon, metric) < km)
    assert ids(geo.within_radius(scattered, lat, lon, km, metric)) == ids(plain)


def test_box_reaches_the_scan(spark, scattered, tmp_path):
    scattered.write.parquet(str(tmp_path / "places"))
    stored = spark.read.parquet(str(tmp_path / "places"))
    text = plan_of(geo.within_city(stored, "A", 45.0, -122.0, 26.0))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(latitude" in pushed and "LessThanOrEqual(longitude" in pushed
    assert "EqualTo(city,A)" in pushed
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "hours" not in schema and "name" not in schema


def test_unknown_city_has_no_centre(scattered):
    assert geo.around_city(scattered, "nowhere", 300.0).count() == 0


def test_photos_stay_with_their_captions(spark):
    places = spark.createDataFrame([place(1, 45.0, -122.0), place(2, 45.1, -122.0)], PLACES)
    photos = spark.createDataFrame(
        [(1, 12, "b"), (1, 11, None), (9, 13, "c")], "place_id long, photo_id long, caption string"
    )
    found = geo.with_photos(geo.within_radius(places, 45.0, -122.0, 50.0), photos)
    rows = {r["place_id"]: r["photos"] for r in found.collect()}
    assert [(p["photo_id"], p["caption"]) for p in rows[1]] == [(11, None), (12, "b")]
    assert rows[2] is None


@pytest.mark.parametrize("same_city", [False, True])
def test_range_join_equals_single_requests(spark, scattered, same_city):
    asked = [(1, "u1", "A", 45.0, -122.0, 30.0), (2, "u2", "B", 45.2, -121.9, 7.0), (3, "u1", "B", -10.0, 20.0, 900.0), (4, "u3", "A", 44.99, -122.01, 0.5)]
    requests = spark.createDataFrame(
        asked, "request_id long, user_id string, city string, center_lat double, center_lon double, km double"
    )
    for rows in (8, 100, 10_000):
        joined = geo.range_join(scattered, requests, cell_rows=rows, same_city=same_city)
        expected = []
        for key, _, city, lat, lon, km in asked:
            base = scattered.where(F.col("city") == city) if same_city else scattered
            expected += [(key, *r) for r in ids(geo.within_radius(base, lat, lon, km))]
        assert ids(joined, "request_id", "place_id") == sorted(expected)


def test_long_messages_continue_in_parts(spark, scattered):
    requests = spark.createDataFrame(
        [(1, "u1", "A", 45.0, -122.0, 60.0)],
        "request_id long, user_id string, city string, center_lat double, center_lon double, km double",
    )
    found = geo.range_join(scattered, requests).select("request_id", "user_id", "place_id", "dist_km", "stars")
    whole = geo.range_messages(found).collect()
    assert len(whole) == 1
    order = [(e["dist_km"], e["place_id"]) for e in whole[0]["business_id_listInRange"]]
    assert order == sorted(order)
    parts = geo.range_messages(found, rows=200).collect()
    assert len(parts) > 1
    assert sorted(e["place_id"] for p in parts for e in p["business_id_listInRange"]) == sorted(e[1] for e in order)


def test_reviews_appear_once(spark):
    reviews = spark.createDataFrame([(1, 5.0), (1, 3.0), (2, 1.0)], "place_id long, stars double")
    found = spark.createDataFrame([(1, 0.5), (1, 0.7)], "place_id long, dist_km double")
    assert geo.reviews_in_range(reviews, found).count() == 2


def test_only_points_parse(spark):
    rows = spark.createDataFrame(
        [("POINT(45.5 -122.25)",), ("POINT (1e1 2)",), ("LINESTRING(1 2, 3 4)",), (None,)], "w string"
    ).select(wkt_latitude(F.col("w")), wkt_longitude(F.col("w")))
    assert [tuple(r) for r in rows.collect()] == [(45.5, -122.25), (10.0, 2.0), (None, None), (None, None)]


def test_metric_is_checked():
    with pytest.raises(ValueError):
        distance_km(1.0, 2.0, 3.0, 4.0, "furlong")


def test_places_appear_once_and_in_order_over_pages(spark, scattered):
    requests = spark.createDataFrame(
        [(1, "u1", "A", 45.0, -122.0, 60.0)],
        "request_id long, user_id string, city string, center_lat double, center_lon double, km double",
    )
    found = geo.range_join(scattered, requests).select("request_id", "user_id", "place_id", "dist_km")
    first = found.orderBy("dist_km", "place_id").first()["place_id"]
    photos = spark.createDataFrame([(first, n, None) for n in range(50)], "place_id long, photo_id long, caption string")
    listed = geo.with_photos(found, photos, rows=10)
    assert listed.count() == found.count()
    shown = listed.where(F.col("place_id") == first).first()
    assert [p["photo_id"] for p in shown["photos"]] == list(range(10)) and shown["photo_pages"] == 5
    rest = sorted(geo.further_photos(found, photos, rows=10).collect(), key=lambda r: r["part"])
    assert [p["photo_id"] for r in rest for p in r["photos"]] == list(range(10, 50))
    pages = sorted(geo.range_messages(listed.drop("photo_pages"), rows=100).collect(), key=lambda r: r["part"])
    order = [(e["dist_km"], e["place_id"]) for p in pages for e in p["business_id_listInRange"]]
    assert len(pages) > 1 and order == sorted(order) and len(set(order)) == found.count()


def test_queries_show_all_photos_of_a_hot_place(spark, monkeypatch):
    places = spark.createDataFrame([place(1, 45.5, -122.5, geo_queries.CITY), place(2, 45.51, -122.5, geo_queries.CITY)], PLACES)
    photos = spark.createDataFrame([(1, n, None if n % 2 else f"c{n}") for n in range(350)], "place_id long, photo_id long, caption string")
    requests = spark.createDataFrame(
        [(1, "u1", geo_queries.CITY, 45.5, -122.5, 20.0)],
        "request_id long, user_id string, city string, center_lat double, center_lon double, km double",
    )
    for name, table in (("places", places), ("photos", photos), ("requests", requests)):
        monkeypatch.setattr(geo_queries.views, name, lambda spark, sf, table=table: table)
    shown = geo_queries.places_with_photos(spark, "").orderBy("place_id", "pos").collect()
    assert [(r["pos"], r["photo_id"], r["caption"], r["n_photos"]) for r in shown if r["place_id"] == 1] == [
        (n, n, None if n % 2 else f"c{n}", 350) for n in range(350)
    ]
    assert [(r["pos"], r["photo_id"], r["n_photos"]) for r in shown if r["place_id"] == 2] == [(None, None, 0)]
    entries = geo_queries.range_message_entries(spark, "").collect()
    assert {r["place_id"]: r["n_photos"] for r in entries} == {1: 350, 2: 0}


@pytest.mark.parametrize("limit", [20_000, 200_000])
def test_messages_keep_their_bound_whatever_the_rows(spark, scattered, limit):
    """A hundred wide photos a place, thousands of places of one request."""
    requests = spark.createDataFrame(
        [(1, "u1", "A", 45.0, -122.0, 60.0), (2, "u2", "A", 45.0, -122.0, 3.0)],
        "request_id long, user_id string, city string, center_lat double, center_lon double, km double",
    )
    found = geo.range_join(scattered, requests).select("request_id", "user_id", "place_id", "dist_km")
    numbers = F.expr("explode(sequence(0L, 99L))").alias("photo_id")
    photos = scattered.select("place_id", numbers).withColumn("caption", F.repeat(F.lit("é"), 90))
    pages = geo.all_photos(found, photos, limit=4_000)
    listed = geo.beside(found, pages).drop("photo_pages")
    messages = geo.range_messages(listed, limit=limit)
    sizes = messages.select(F.octet_length(F.to_json(F.struct("user_id", "business_id_listInRange"))).alias("n"))
    assert sizes.where(F.col("n") > limit).count() == 0 and sizes.count() > 2
    assert pages.where(F.octet_length(F.to_json(F.struct("photos"))) > 4_000).count() == 0
    places = {}
    for m in sorted(messages.collect(), key=lambda m: m["part"]):
        places.setdefault(m["request_id"], []).extend((e["dist_km"], e["place_id"]) for e in m["business_id_listInRange"])
    wanted = {}
    for r in found.collect():
        wanted.setdefault(r["request_id"], []).append((r["dist_km"], r["place_id"]))
    assert places == {k: sorted(v) for k, v in wanted.items()}
    kept = {}
    for p in sorted(pages.collect(), key=lambda p: p["part"]):
        kept.setdefault(p["place_id"], []).extend(x["photo_id"] for x in p["photos"])
    assert all(v == list(range(100)) for v in kept.values()) and len(kept) == found.select("place_id").distinct().count()


def test_running_sums_are_those_of_each_group(spark):
    rows = [(n % 3 if n % 7 else None, n, n % 11) for n in range(500)]
    df = spark.createDataFrame(rows, "k long, at long, v long").repartition(5)
    got = {(r["k"], r["at"]): r["before"] for r in running_sums(df, ["k"], [F.col("at")], F.col("v"), "before").collect()}
    wanted, total = {}, {}
    for k, at, v in rows:
        wanted[k, at] = total.get(k, 0)
        total[k] = total.get(k, 0) + v
    assert got == wanted
    assert running_sums(df.limit(0), ["k"], [F.col("at")], F.col("v"), "before").count() == 0


@pytest.mark.parametrize("metric", ["planar100", "haversine"])
def test_stored_places_skip_files(spark, scattered, tmp_path, metric):
    """A radius over places stored by zone opens the files of its zones only, and finds the same places."""
    path = str(tmp_path / "by_zone")
    scattered = scattered.where("place_id % 20 = 0 OR place_id > 3000")
    spatial.write_places(scattered, path, records_per_file=200)
    files = len(spark.read.parquet(path).inputFiles())
    for lat, lon, km in ((45.0, -122.0, 30.0), (-89.9, 179.9, 40.0), (0.1, -0.1, 5.0), (10.0, 20.0, 2500.0)):
        near = spatial.read_places(spark, path, lat, lon, km, metric)
        expected = ids(geo.within_radius(scattered, lat, lon, km, metric))
        assert ids(geo.within_radius(near, lat, lon, km, metric)) == expected
        if km < 100:
            near.collect()
            scan = near._jdf.queryExecution().executedPlan().collectLeaves().head()
            assert scan.metrics().apply("numFiles").value() < files * 0.2
    text = plan_of(geo.within_radius(spatial.read_places(spark, path, 45.0, -122.0, 30.0), 45.0, -122.0, 30.0))
    scan = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert spatial.ROW in scan and spatial.COLUMN in scan
    assert "GreaterThanOrEqual(latitude" in next(line for line in text.splitlines() if "PushedFilters" in line)


def test_interleaved_bits(spark):
    points = [(-90.0, -180.0), (90.0, 180.0), (-90.0, 180.0), (0.0, 0.0), (-89.999, -180.0)]
    df = spark.createDataFrame(points, "latitude double, longitude double")
    got = [r[0] for r in df.select(spatial.interleaved(F.col("latitude"), F.col("longitude"))).collect()]
    assert got == [0, 2**32 - 1, 0xAAAAAAAA, 3 << 30, 0]


def test_copies_of_a_request(spark, scattered):
    """Few cells where places are thin, however wide the circle; small ones where they crowd; salts there alone."""
    requests = spark.createDataFrame(
        [(1, "u", 45.0, -122.0, 10.0), (2, "u", 0.0, 0.0, 300.0), (3, "u", -50.0, 60.0, 3_000.0), (4, "u", 70.0, 179.9, 30.0)],
        "request_id long, user_id string, center_lat double, center_lon double, km double",
    )
    cells = geo.place_cells(scattered, 64)
    copies = {}
    for r in geo.cells_of_requests(requests, cells).collect():
        copies.setdefault(r["request_id"], []).append((r["_level"], r["salts"]))
    assert len(copies[2]) <= 4 and len(copies[3]) <= 30 and {s for i in (2, 3, 4) for _, s in copies[i]} == {1}
    assert max(level for level, _ in copies[1]) >= 3 and len(copies[1]) <= 16
    one_spot = spark.createDataFrame([place(i, 45.0, -122.0) for i in range(500)] + [place(900, 10.0, 10.0)], PLACES)
    spread = {(r["level"], r["salts"]) for r in geo.place_cells(one_spot, 64).collect()}
    assert spread == {(0, 1), (geo.FINEST, 8)}
    assert geo.range_join(one_spot, requests, 64).where("request_id = 1").count() == 500
    assert geo.range_join(one_spot.limit(0), requests, 64).count() == 0


def test_a_city_has_a_tree_of_its_own(spark):
    """Cells stay wide, and a request's copies few, where the places that crowd are of many cities."""
    rows = [place(i, 45 + i % 20 / 20, -122 - i % 19 / 19) for i in range(1_000)]
    places = spark.createDataFrame(rows, PLACES).withColumn("city", (F.col("place_id") % 25).cast("string"))
    mixed, own = geo.place_cells(places, 64), geo.place_cells(places, 64, ["city"])
    assert max(r["level"] for r in mixed.collect()) > 0 == max(r["level"] for r in own.collect())
