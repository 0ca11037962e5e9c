"""Projections, filters, indexes and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from savormap.operators import recommend, shaping
from savormap.plans import views
from savormap.plans.registry import query
from savormap.plans.views import sql_over
from savormap.storage import cut_lineage


@query(
    "P1 P2",
    sql_over("ratings", "SELECT user_id, item_id AS place_id, stars AS score, ts AS rated_at FROM ratings"),
)
def renamed_ratings(spark, sf):
    return (
        views.ratings(spark, sf)
        .select("user_id", "item_id", F.col("stars").alias("score"), F.col("ts").alias("rated_at"), "l_orderkey")
        .withColumnRenamed("item_id", "place_id")
        .drop("l_orderkey")
    )


@query(
    "P3",
    sql_over("photos", "SELECT place_id, photo_id, caption FROM photos WHERE place_id IS NOT NULL AND caption IS NOT NULL"),
)
def captioned_photos(spark, sf):
    return shaping.known_rows(views.photos(spark, sf), "place_id", "caption")


@query("P4", sql_over("places", "SELECT place_id, name, latitude, longitude FROM places WHERE city = 'NATION_3'"))
def city_places(spark, sf):
    found = views.places(spark, sf).where(F.col("city") == "NATION_3")
    return found.select("place_id", "name", "latitude", "longitude")


@query(
    "P5 F-13",
    sql_over("places", "SELECT place_id, CAST(stars AS FLOAT) AS stars FROM places WHERE stars > 4"),
)
def well_starred_places(spark, sf):
    as_text = views.places(spark, sf).select("place_id", F.col("stars").cast("string").alias("stars"))
    return shaping.stars_above(as_text)


@query("P7", sql_over("ratings", "SELECT DISTINCT user_id, item_id, stars FROM ratings"))
def distinct_ratings(spark, sf):
    return views.ratings(spark, sf).select("user_id", "item_id", "stars").distinct()


@query("P8", sql_over("ratings", "SELECT DISTINCT item_id FROM ratings"))
def distinct_items(spark, sf):
    return views.ratings(spark, sf).select("item_id").distinct()


@query("P9", "SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY text")
def first_of_each_text(spark, sf):
    return shaping.one_per_text(views.table(spark, sf, "documents"), "text", "doc_id", ["doc_id", "lang"])


@query(
    "P10",
    sql_over(
        "ratings",
        "SELECT item_id, dense_rank() OVER (ORDER BY item_id) - 1 AS item_idx FROM (SELECT DISTINCT item_id FROM ratings)",
    ),
)
def item_index(spark, sf):
    return shaping.dense_index(views.ratings(spark, sf), "item_id", "item_idx")


@query(
    "P11 J1",
    sql_over(
        "ratings",
        """, u AS (SELECT user_id, dense_rank() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM ratings)),
        i AS (SELECT item_id, dense_rank() OVER (ORDER BY item_id) - 1 AS item_idx FROM (SELECT DISTINCT item_id FROM ratings))
        SELECT user_id, item_id, user_idx, item_idx, stars FROM ratings JOIN u USING (user_id) JOIN i USING (item_id)""",
    ),
)
def indexed_ratings(spark, sf):
    rated = views.ratings(spark, sf).select("user_id", "item_id", "stars")
    users = shaping.dense_index(rated, "user_id", "user_idx")
    items = shaping.dense_index(rated, "item_id", "item_idx")
    return recommend.indexed(rated, users, items)


@query(
    "M1 P1 P3 P7 P9 P10 J1",
    sql_over(
        "reviews",
        """, kept AS (SELECT DISTINCT user_id, item_id, stars FROM (
            SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM reviews)
            WHERE rn = 1 AND user_id IS NOT NULL AND item_id IS NOT NULL AND stars IS NOT NULL)
        SELECT CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_idx,
               CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_idx, stars AS score FROM kept""",
    ),
)
def prepared_ratings(spark, sf):
    return recommend.prepare_ratings(views.reviews(spark, sf), key="doc_id")[0]


_SPLIT_SQL = (
    "CAST(('0x' || substr(md5('42|' || CAST(l_orderkey AS VARCHAR) || '|' || "
    "CAST(l_linenumber AS VARCHAR)), 1, 8)) AS BIGINT) % 1000000 / 1000000.0"
)


@query(
    "P12",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN {_SPLIT_SQL} < 0.8 THEN 'train' ELSE 'test' END AS part
        FROM lineitem""",
)
def train_and_test_rows(spark, sf):
    lines = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    train, test = shaping.split_rows(lines, ["l_orderkey", "l_linenumber"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "P15",
    sql_over("places", "SELECT city, count(*) AS n, max(latitude) AS north FROM places GROUP BY city"),
)
def city_summary_sql(spark, sf):
    return spark.sql(
        "SELECT city, count(*) AS n, max(latitude) AS north FROM {places} GROUP BY city",
        places=views.places(spark, sf),
    )


@query(
    "P10 P11",
    sql_over(
        "ratings",
        """, marked AS (SELECT item_id, min(ts) >= DATE '1995-01-01' AS late FROM ratings GROUP BY item_id)
        SELECT item_id, row_number() OVER (ORDER BY late, item_id) - 1 AS item_idx FROM marked""",
    ),
)
def grown_item_index(spark, sf):
    """Items of the early ratings numbered first; those that come later are added behind them."""
    rated = views.ratings(spark, sf)
    first = cut_lineage(shaping.dense_index(rated.where("ts < date '1995-01-01'"), "item_id", "item_idx"))
    return shaping.extend_index(first, rated, "item_id", "item_idx")
