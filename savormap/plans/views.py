"""The pipeline's tables, derived from the driver tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from savormap.sources.readers import read_parquet


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One driver table."""
    return read_parquet(spark, f"{sf.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """user_id, item_id, stars, ts and the line's own key."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.floor("l_quantity") % 5 + 1).cast("double").alias("stars"),
        F.col("o_orderdate").alias("ts"),
        "l_orderkey",
        "l_linenumber",
    )


def vector_count(spark: SparkSession, sf: str):
    """Number of vectors, as a scalar subquery."""
    return table(spark, sf, "embeddings").agg(F.count(F.lit(1)).alias("n")).scalar()


def vector_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings whose items are vector ids."""
    return ratings(spark, sf).withColumn("item_id", F.col("item_id") % vector_count(spark, sf))


def _coordinates(key: str):
    k = F.col(key)
    return (
        (F.lit(45) + (k * 7919 % 10000) / F.lit(10000.0)).alias("latitude"),
        (F.lit(-122) - (k * 104729 % 10000) / F.lit(10000.0)).alias("longitude"),
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    """place_id, name, address, city, latitude, longitude, stars, hours."""
    customers, nations = table(spark, sf, "customer"), table(spark, sf, "nation")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        F.col("c_custkey").alias("place_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("address"),
        F.col("n_name").alias("city"),
        *_coordinates("c_custkey"),
        (F.col("c_custkey") % 5 + 1).cast("double").alias("stars"),
        F.concat((F.col("c_custkey") % 3 + 8).cast("string"), F.lit(":00-22:00")).alias("hours"),
    )


def photos(spark: SparkSession, sf: str) -> DataFrame:
    """place_id, photo_id, caption (some null)."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("place_id"),
        F.col("o_orderkey").alias("photo_id"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("caption"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """One range request per supplier: a centre, a radius and a city."""
    suppliers, nations = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).select(
        F.col("s_suppkey").alias("request_id"),
        F.concat(F.lit("user-"), F.col("s_suppkey").cast("string")).alias("user_id"),
        F.col("n_name").alias("city"),
        *[c.alias(n) for c, n in zip(_coordinates("s_suppkey"), ("center_lat", "center_lon"))],
        F.lit(20.0).alias("km"),
    )


def features(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as (id, vec array<double>)."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )


def _typed_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        (F.col("event_id") % vector_count(spark, sf)).alias("item_id"),
        (F.floor("value") % 5 + 1).cast("double").alias("rating"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"),
        "event_type",
    )


def rating_events(spark: SparkSession, sf: str) -> DataFrame:
    """event_id, user_id, item_id (a vector id), rating, ts (epoch seconds)."""
    return _typed_events(spark, sf).drop("event_type")


def rating_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The events as JSON; every event of type ``error`` lacks its rating."""
    rating = F.when(F.col("event_type") != "error", F.col("rating"))
    return _typed_events(spark, sf).select(
        F.to_json(
            F.struct(
                F.col("user_id").cast("int").alias("user"),
                F.col("item_id").cast("int").alias("restaurant"),
                rating.alias("rating"),
                F.col("ts").alias("timestamp"),
            )
        ).alias("value")
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted aspect and polarity of each event."""
    value = F.col("value")
    polarity = (
        F.when(value < 20, "negative").when(value < 40, "neutral").when(value < 80, "positive")
    ).otherwise("conflict")
    return table(spark, sf, "events").select(
        F.col("event_type").alias("aspect"), polarity.alias("polarity")
    )


def actual_and_predicted(spark: SparkSession, sf: str) -> DataFrame:
    """Document quality against a length rule."""
    documents = table(spark, sf, "documents").select("doc_id", "n_chars")
    return table(spark, sf, "labels").join(documents, "doc_id").select(
        F.col("quality").cast("string").alias("actual"),
        F.when(F.col("n_chars") > 1000, "1").otherwise("0").alias("predicted"),
    )


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as reviews with string ids."""
    return table(spark, sf, "documents").select(
        "doc_id",
        F.col("source").alias("user_id"),
        F.concat("lang", F.lit("-"), (F.col("n_chars") % 50).cast("string")).alias("item_id"),
        (F.col("n_chars") % 5 + 1).cast("double").alias("stars"),
        "text",
    )


_LAT = "45 + ({k} * 7919 % 10000) / CAST(10000.0 AS DOUBLE)"
_LON = "-122 - ({k} * 104729 % 10000) / CAST(10000.0 AS DOUBLE)"

VIEW_SQL = {
    "ratings": """
        SELECT o_custkey AS user_id, l_partkey AS item_id,
               CAST(CAST(floor(l_quantity) AS BIGINT) % 5 + 1 AS DOUBLE) AS stars,
               o_orderdate AS ts, l_orderkey, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "vector_ratings": """
        SELECT o_custkey AS user_id, l_partkey % (SELECT count(*) FROM embeddings) AS item_id,
               CAST(CAST(floor(l_quantity) AS BIGINT) % 5 + 1 AS DOUBLE) AS stars,
               o_orderdate AS ts, l_orderkey, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "places": f"""
        SELECT c_custkey AS place_id, c_name AS name, c_mktsegment AS address, n_name AS city,
               {_LAT.format(k="c_custkey")} AS latitude, {_LON.format(k="c_custkey")} AS longitude,
               CAST(c_custkey % 5 + 1 AS DOUBLE) AS stars,
               CAST(c_custkey % 3 + 8 AS VARCHAR) || ':00-22:00' AS hours
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "photos": """
        SELECT o_custkey AS place_id, o_orderkey AS photo_id, nullif(o_orderstatus, 'P') AS caption
        FROM orders""",
    "requests": f"""
        SELECT s_suppkey AS request_id, 'user-' || CAST(s_suppkey AS VARCHAR) AS user_id, n_name AS city,
               {_LAT.format(k="s_suppkey")} AS center_lat, {_LON.format(k="s_suppkey")} AS center_lon,
               CAST(20 AS DOUBLE) AS km
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "found": """
        SELECT r.request_id, r.user_id, p.*,
               sqrt(pow(latitude - center_lat, 2) + pow(longitude - center_lon, 2)) * 100 AS dist_km
        FROM requests r JOIN places p ON p.city = r.city
        WHERE sqrt(pow(latitude - center_lat, 2) + pow(longitude - center_lon, 2)) * 100 < km""",
    "features": "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings",
    "sims": """
        SELECT x.id AS a, y.id AS b, list_cosine_similarity(x.vec, y.vec) AS sim
        FROM features x JOIN features y ON x.id <> y.id
        WHERE list_cosine_similarity(x.vec, y.vec) > 0.3""",
    "rating_events": """
        SELECT event_id, user_id, event_id % (SELECT count(*) FROM embeddings) AS item_id,
               CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS DOUBLE) AS rating,
               epoch_us(ts) // 1000000 AS ts, event_type
        FROM events""",
    "recent": """
        SELECT user_id, item_id, stars FROM vector_ratings
        QUALIFY row_number() OVER (PARTITION BY user_id
            ORDER BY ts DESC, item_id, l_orderkey, l_linenumber) <= 20""",
    "predictions": """
        SELECT event_type AS aspect,
               CASE WHEN value < 20 THEN 'negative' WHEN value < 40 THEN 'neutral'
                    WHEN value < 80 THEN 'positive' ELSE 'conflict' END AS polarity
        FROM events""",
    "actual_and_predicted": """
        SELECT CAST(quality AS VARCHAR) AS actual,
               CASE WHEN n_chars > 1000 THEN '1' ELSE '0' END AS predicted
        FROM labels JOIN documents USING (doc_id)""",
    "reviews": """
        SELECT doc_id, source AS user_id, lang || '-' || CAST(n_chars % 50 AS VARCHAR) AS item_id,
               CAST(n_chars % 5 + 1 AS DOUBLE) AS stars, text
        FROM documents""",
}

_NEEDS = {
    "found": ("requests", "places"),
    "sims": ("features",),
    "recent": ("vector_ratings",),
}


def sql_over(names: str, body: str) -> str:
    """``body`` under the named views and those they need."""
    ordered: list[str] = []
    for name in names.split():
        for one in (*_NEEDS.get(name, ()), name):
            if one not in ordered:
                ordered.append(one)
    views = ",\n".join(f"{n} AS ({VIEW_SQL[n].strip()})" for n in ordered)
    return f"WITH {views}\n{body.strip()}"
