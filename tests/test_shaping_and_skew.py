"""Indexes, splits, deduplication, and hot groups."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from savormap import skew
from savormap.operators import ranking, shaping
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def hot(spark):
    """12,000 rows; key 0 and the null key hold a third each."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 50 + 1)
    return spark.range(12_000).select(key.alias("k"), F.col("id").alias("v")).repartition(8).cache()


def test_index_is_a_bijection_in_id_order(spark):
    ids = spark.range(5000).select(F.concat(F.lit("u"), F.col("id") % 1700).alias("u")).repartition(16)
    ids = ids.unionByName(spark.createDataFrame([(None,)], "u string"))
    rows = shaping.dense_index(ids, "u", "idx").orderBy("idx").collect()
    assert [r["idx"] for r in rows] == list(range(1700))
    names = [r["u"] for r in rows]
    assert names == sorted(names)


def test_split_is_whole_and_repeatable(hot):
    first, second = shaping.split_rows(hot, ["k", "v"])
    a, b = {r["v"] for r in first.collect()}, {r["v"] for r in second.collect()}
    assert not a & b and len(a | b) == 12_000 and 0.78 < len(a) / 12_000 < 0.82
    again = {r["v"] for r in shaping.split_rows(hot.repartition(3), ["k", "v"])[0].collect()}
    assert again == a


def test_lowest_key_survives(spark):
    rows = spark.createDataFrame(
        [(3, "x", "c"), (1, "x", "a"), (2, "y", "b"), (5, None, "n"), (4, None, "m")],
        "key int, text string, who string",
    )
    for digest in (True, False):
        got = shaping.one_per_text(rows, "text", "key", ["key", "who"], digest)
        assert sorted((r["key"], r["who"]) for r in got.collect()) == [(1, "a"), (2, "b"), (4, "m")]


def test_stars_must_read_as_number_and_exceed(spark):
    rows = spark.createDataFrame([("4.5",), ("4",), ("null",), (None,), ("5",)], "stars string")
    assert sorted(r["stars"] for r in shaping.stars_above(rows).collect()) == [4.5, 5.0]


def lists(df):
    return Counter((r["k"], e["v"]) for r in df.collect() for e in r["vs"])


@pytest.mark.parametrize("small_rows", [10_000, 0])
def test_hot_groups_are_cut_and_whole(hot, monkeypatch, small_rows):
    monkeypatch.setattr(skew, "SMALL_ROWS", small_rows)
    got = skew.gather_lists(hot, ["k"], ["v"], "vs", rows=500)
    rows = got.collect()
    assert lists(got) == Counter((r["k"], r["v"]) for r in hot.collect())
    assert max(len(r["vs"]) for r in rows) < 800
    assert len([r for r in rows if r["k"] == 0]) == 8
    assert len([r for r in rows if r["k"] is None]) == 8
    assert all(r["part"] == 0 for r in rows if r["k"] not in (0, None))
    assert all([e["v"] for e in r["vs"]] == sorted(e["v"] for e in r["vs"]) for r in rows)


def test_groups_within_the_limit_give_one_list(hot):
    got = skew.gather_lists(hot, ["k"], ["v"], "vs", order_by=[-F.col("v")]).collect()
    assert len({r["k"] for r in got}) == len(got)
    assert all([e["v"] for e in r["vs"]] == sorted((e["v"] for e in r["vs"]), reverse=True) for r in got)


def test_lookup_is_broadcast_only_when_small(spark, hot):
    lookup = spark.range(60).select(F.col("id").alias("k"), F.lit("x").alias("x"))
    assert "BroadcastHashJoin" in plan_of(skew.lookup_join(hot, lookup, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan_of(skew.lookup_join(hot, lookup, ["k"], rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rank_is_limited_before_the_shuffle(hot):
    top = ranking.top_per_group(hot, ["k"], [F.col("v").desc()], 3)
    text = plan_of(top)
    assert text.count("WindowGroupLimit") >= 2
    best = sorted((r["v"] for r in top.where("k = 0").collect()), reverse=True)
    assert best == [11_997, 11_994, 11_991]


def test_well_starred_keeps_only_above_four(spark):
    row = spark.sql(
        "SELECT array(named_struct('place_id', 1, 'stars', '4.5'), named_struct('place_id', 2, 'stars', '4'), "
        "named_struct('place_id', 3, 'stars', 'null')) AS l"
    )
    assert row.select(shaping.well_starred(F.col("l"))).first()[0] == [1]


def test_skewed_join_is_split(spark):
    """One user with a third of the ratings is read by several tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    }
    user = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    rated = spark.range(300_000).select(
        user.alias("user_id"), (F.col("id") % 40).alias("item_id"), F.rand(1).alias("stars")
    )
    index = spark.range(5000).select(F.col("id").alias("user_id"), (F.col("id") * 2).alias("user_idx"))
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        joined = rated.join(index, "user_id").groupBy("item_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum("user_idx").alias("s")
        )
        rows = joined.collect()
        final = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in small:
            spark.conf.unset(key)
    assert "skew=true" in final
    assert sum(r["n"] for r in rows) == 300_000


def test_a_row_without_a_key_never_wins(spark):
    rows = spark.createDataFrame([("t", None, "x"), ("t", 5, "y"), ("u", None, "z")], "text string, key int, who string")
    got = shaping.one_per_text(rows, "text", "key", ["key", "who"])
    assert sorted(r["who"] for r in got.collect()) == ["y", "z"]


def test_best_row_has_a_measure(spark):
    rows = spark.createDataFrame([("a", None), ("b", 0.5), ("c", float("nan"))], "k string, m double")
    assert ranking.best_row(rows, "m", ["k"]).first()["k"] == "b"


def test_pages_follow_the_order(spark, hot):
    got = skew.gather_lists(hot, ["k"], ["v"], "vs", order_by=[-F.col("v")], rows=300)
    pages = {}
    for r in sorted(got.collect(), key=lambda r: r["part"]):
        held = pages.setdefault(r["k"], [])
        assert r["part"] * 300 == len(held) and len(r["vs"]) <= 300
        held += [e["v"] for e in r["vs"]]
    assert pages and all(p == sorted(p, reverse=True) for p in pages.values())
    assert sum(map(len, pages.values())) == hot.count()


def test_an_index_grows_and_keeps_its_numbers(spark):
    ids = lambda *values: spark.createDataFrame([(v, 1) for v in values], "id string, extra int")
    index = shaping.dense_index(ids("m", "c", "m"), "id", "n")
    grown = shaping.extend_index(index, ids("z", "c", "a", "a", None), "id", "n")
    assert sorted((r["n"], r["id"]) for r in grown.collect()) == [(0, "c"), (1, "m"), (2, "a"), (3, "z")]
    again = shaping.extend_index(grown, ids("a", "b"), "id", "n")
    assert sorted((r["n"], r["id"]) for r in again.collect())[4:] == [(4, "b")] and again.count() == 5
    from_nothing = shaping.extend_index(index.limit(0), ids("q", "p"), "id", "n")
    assert sorted((r["n"], r["id"]) for r in from_nothing.collect()) == [(0, "p"), (1, "q")]
