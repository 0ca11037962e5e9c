"""Lists of places in range made without a shuffle of the places in range."""

import random

import pytest
from pyspark.sql import functions as F

from savormap.operators import geo, range_lists
from savormap.plans import geo_queries
from tests.conftest import plan_of

REQUESTS = "request_id long, user_id string, city string, center_lat double, center_lon double, km double"
ITEMS = ["place_id", "name", "dist_km", "photos"]


@pytest.fixture(scope="module")
def places(spark):
    rng = random.Random(3)
    rows = [(i, f"p{i}", "AB"[i % 2], 45 + round(rng.gauss(0, 0.2), 2), -122 + round(rng.gauss(0, 0.2), 2)) for i in range(1200)]
    rows += [(2000, None, "A", -60.0, 170.0), (None, "x", "A", 45.0, -122.0), (2001, "y", None, 45.0, -122.0), (2002, "z", "A", None, -122.0), (7, "twice", "B", 45.0, -122.0)]
    photo = F.when(F.col("place_id") % 3 > 0, F.array(F.struct(F.col("place_id").alias("photo_id"), F.nullif("name", F.lit("p4")).alias("caption"))))
    df = spark.createDataFrame(rows, "place_id long, name string, city string, latitude double, longitude double")
    return df.withColumn("photos", photo).repartition(4).cache()


@pytest.fixture(scope="module")
def requests(spark):
    rng = random.Random(4)
    rows = [(i, f"u{i}", "AB"[i % 2], 45 + rng.gauss(0, 0.2), -122 + rng.gauss(0, 0.2), rng.choice([0.5, 6.0, 20.0, 90.0])) for i in range(40)]
    rows += [(50, "wide", "A", 0.0, 0.0, 1_500.0), (51, "wider", "A", 0.0, 0.0, 3_000.0), (52, "u", None, 45.0, -122.0, 9.0)]
    rows += [(3, "u3", "B", 45.0, -122.0, 11.0), (None, None, "A", 45.0, -122.0, 8.0), (53, "none", "A", 45.0, -122.0, 0.0)]
    return spark.createDataFrame(rows, REQUESTS).repartition(3).cache()


def by_shuffle(places, requests, same_city, **bounds):
    found = geo.range_join(places, requests, same_city=same_city).select("request_id", "user_id", *ITEMS)
    return geo.range_messages(found, **bounds)


def entries(messages):
    return sorted(
        (repr(m["request_id"]), m["part"], n, e["place_id"], e["dist_km"], repr(e["name"]), repr(e["photos"]))
        for m in messages.collect()
        for n, e in enumerate(m["business_id_listInRange"])
    )


@pytest.mark.parametrize("same_city, hot", [(False, 300), (True, range_lists.HOT_ROWS)])
def test_same_lists_as_by_shuffle(places, requests, same_city, hot, monkeypatch):
    """Repeated and missing ids, wide circles, and tiles that are too crowded for a task or dealt out over several."""
    monkeypatch.setattr(range_lists, "SHARE", 500)
    once = places.where("name IS DISTINCT FROM 'twice'")
    got = range_lists.range_lists(once, requests, ITEMS, same_city, rows=7, hot_rows=hot).cache()
    assert entries(got) == entries(by_shuffle(once, requests, same_city, rows=7))
    sizes = {}
    for m in got.collect():
        sizes.setdefault((m["request_id"], m["user_id"]), []).append((m["part"], m["ahead"], len(m["business_id_listInRange"]), m["n_places"]))
    for pages in sizes.values():
        pages.sort()
        assert [p[1] for p in pages] == [sum(q[2] for q in pages[:n]) for n in range(len(pages))]
        assert {p[3] for p in pages} == {sum(q[2] for q in pages)}


def test_pages_keep_their_bytes(places, requests, monkeypatch):
    """Whatever is handed on at a time; a place that stands twice is listed twice."""
    monkeypatch.setattr(range_lists, "_FLUSH_ROWS", 50)
    got = range_lists.range_lists(places, requests, ITEMS, True, limit=3_000).cache()
    value = F.octet_length(F.to_json(F.struct("user_id", "business_id_listInRange")))
    assert got.where(value > 3_000).count() == 0 and got.agg(F.max("part")).first()[0] > 3
    flat = lambda m: sorted((r[0], r[3], r[4]) for r in entries(m))
    assert flat(got) == flat(by_shuffle(places, requests, True))


def test_nothing_in_range(places, requests):
    assert range_lists.range_lists(places.limit(0), requests, ITEMS, True).count() == 0
    assert range_lists.range_lists(places, requests.limit(0), ITEMS, True).count() == 0


@pytest.mark.parametrize("name", ["range_message_pages", "entries_of_small_messages", "range_message_entries"])
def test_queries_shuffle_no_places_in_range(spark, name):
    """Once requests have met places, nothing is shuffled (operators stand above what they read)."""
    tree = plan_of(getattr(geo_queries, name)(spark, "/root/testdata/sf0.001")).split("\n\n")[0]
    after = tree[: tree.index("FlatMapGroupsInArrow")] if "FlatMapGroupsInArrow" in tree else tree
    assert "Exchange" not in after.replace("BroadcastExchange", "") and "FlatMapGroupsInArrow" in tree
