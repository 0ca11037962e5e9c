"""The pipeline's jobs, for ``spark-submit``: ``python -m savormap.jobs <job> --help``.

Tables keep their outside column name ``business_id``; the operators call it
``place_id``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from savormap import schemas
from savormap.functions.text import normal_tokens
from savormap.operators import classify, geo, metrics, ranking, recommend, shaping
from savormap.operators.similarity import LIST_THRESHOLD, similar_pairs
from savormap.session import build_session
from savormap.sources import readers, writers
from savormap.sources.lookup import LookupTable
from savormap.storage import cut_lineage, remove_scratch
from savormap.streaming import jobs as streams

_NO_OPTIONS: dict[str, str] = {}


def _places(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("business_id", "place_id")


def publish_range(
    places: DataFrame,
    photos: DataFrame,
    city: str,
    lat: float,
    lon: float,
    km: float,
    user: str,
    fmt: str = "kafka",
    **options: str,
) -> None:
    """A city's places around a point, with photos, as one message for a user."""
    keep = ["place_id", *[c for c in geo.PLACE_DETAILS if c != "dist_km"]]
    found = cut_lineage(geo.within_city(_places(places), city, lat, lon, km, keep=keep))
    pages = cut_lineage(geo.all_photos(found, _places(photos)))
    listed = (
        geo.beside(found, pages)
        .drop("photo_pages")
        .withColumnRenamed("place_id", "business_id")
        .withColumns({"request_id": F.lit(0), "user_id": F.lit(user)})
    )
    messages = geo.range_messages(listed, place="business_id")
    keyed = writers.as_messages(messages, "user_id", "business_id_listInRange", key=F.col("user_id"))
    writers.publish(keyed, fmt, **options)
    more = pages.where("part > 0").withColumnRenamed("place_id", "business_id")
    more = more.withColumn("user_id", F.lit(user))
    writers.publish(writers.as_messages(more, "user_id", "business_id", "part", "photos", key=F.col("user_id")), fmt, **options)


def store_city_reviews(
    places: DataFrame, reviews: DataFrame, city: str, km: float, fmt: str, **options: str
) -> None:
    """Reviews of the places around a city's centre, as a collection."""
    found = geo.around_city(_places(places), city, km).withColumnRenamed("place_id", "business_id")
    writers.overwrite_collection(geo.reviews_in_range(reviews, found, "business_id"), fmt, **options)


def store_factors(
    reviews: DataFrame,
    fmt: str,
    user_options: dict[str, str],
    place_options: dict[str, str],
    similar_options: dict[str, str] | None = None,
    lists_options: dict[str, str] | None = None,
    chain: str | None = None,
) -> None:
    """User and place vectors as two collections; on request what follows from them.

    ``similar_options``: the similar-place lists; ``lists_options``: each user's
    recommendation list; ``chain``: a folder for the Parquet tables that
    ``answer-ratings`` reads (``ratings``, ``sims``) and the indexes behind their
    numbers (``users``, ``items``).
    """
    numbered, users, items = recommend.prepare_ratings(reviews, item="business_id", text=None)
    model = recommend.fit_factors(numbered)
    of_users, of_items = recommend.factor_tables(model, users, items, item="business_id")
    writers.overwrite_collection(of_users, fmt, **user_options)
    writers.overwrite_collection(
        of_items.withColumnRenamed("item_feature", "res_feature"), fmt, **place_options
    )
    if lists_options is not None:
        best = recommend.recommend_all(model, users, items, item="business_id")
        lists = recommend.scored_lists(best, "user_id", "business_id")
        writers.overwrite_collection(lists, fmt, **lists_options)
    if similar_options is None and chain is None:
        return
    sims = cut_lineage(similar_pairs(model.itemFactors, "id", "features", LIST_THRESHOLD))
    if chain is not None:
        store_chain(reviews, users, items, sims, chain)
    if similar_options is not None:
        named = sims.join(items.select(F.col("item_idx").alias("a"), F.col("business_id").alias("resId")), "a").join(
            items.select(F.col("item_idx").alias("b"), F.col("business_id").alias("similarId")), "b"
        )
        lists = recommend.scored_lists(named.select("resId", "similarId", "sim"), "resId", "similarId", "sim")
        writers.overwrite_collection(lists, fmt, **similar_options)


def store_chain(reviews: DataFrame, users: DataFrame, items: DataFrame, sims: DataFrame, folder: str) -> None:
    """Indexes, numbered ratings and similar places, as the rating stream reads them."""
    rated = recommend.indexed(
        shaping.known_rows(reviews, "user_id", "business_id", "stars"), users, items, item="business_id"
    ).select(
        F.col("user_idx").alias("user_id"),
        F.col("item_idx").alias("item_id"),
        F.col("stars").cast("double").alias("stars"),
        F.unix_seconds("date").alias("ts"),
    )
    for name, table in (("users", users), ("items", items), ("ratings", rated)):
        writers.overwrite_collection(table, "parquet", path=f"{folder}/{name}")
    similar_lookup(sims.sparkSession, f"{folder}/sims").write(sims)


def similar_lookup(spark: SparkSession, path: str) -> LookupTable:
    """Similar places, laid out by the first one."""
    return LookupTable(spark, path, T.StructType.fromDDL("a long, b long, sim double"), "a")


def tune_factors(
    reviews: DataFrame,
    ranks: Sequence[int] = recommend.GRID_RANKS,
    regularisations: Sequence[float] = recommend.GRID_REGULARISATIONS,
    iterations: Sequence[int] = recommend.GRID_ITERATIONS,
) -> tuple[DataFrame, DataFrame]:
    """Error of every setting, and the best one."""
    keyed = reviews.withColumn("_review", F.xxhash64("user_id", "business_id", "date", "stars"))
    numbered, _, _ = recommend.prepare_ratings(keyed, item="business_id", key="_review")
    train, test = shaping.split_rows(cut_lineage(numbered), ["user_idx", "item_idx", "score"])
    table = recommend.grid_search(train, test, ranks, regularisations, iterations)
    return table, ranking.best_row(table, "rmse", ["rank", "regularisation", "iterations"])


def rank_range(messages: DataFrame, user_features: DataFrame, place_features: DataFrame) -> DataFrame:
    """Places of the range messages by the user's affinity, best first."""
    flat = shaping.unnest(messages, "business_id_listInRange", "user_id")
    ranked = recommend.rank_by_affinity(
        flat.select("user_id", "business_id", "stars"),
        user_features,
        place_features.withColumnRenamed("res_feature", "item_feature"),
        place="business_id",
    )
    return ranked.orderBy(F.col("affinity").desc(), "user_id", "business_id")


def review_report(labelled: DataFrame, iterations: int = 30) -> dict[str, DataFrame]:
    """Train on 80 % of labelled reviews, predict the rest, and report by aspect.

    Gives ``aspects`` (ranking and polarity percentages) and the two
    classification reports, ``aspect_category`` and ``polarity``.
    """
    known = shaping.known_rows(labelled, "text", "aspect_category", "polarity")
    ready = cut_lineage(known.withColumn("tokens", normal_tokens(F.col("text"))))
    train, test = shaping.split_rows(ready, ["text"])
    models = classify.fit_text_classifiers(train, ("aspect_category", "polarity"), iterations=iterations)
    scored = cut_lineage(
        classify.predict_several(models, test.select("text", "tokens", "aspect_category", "polarity"))
        .withColumnRenamed("predicted_aspect_category", "aspect")
    )
    reports = {}
    for label, output in (("aspect_category", "aspect"), ("polarity", "predicted_polarity")):
        reports[label] = metrics.classification_report(metrics.confusion(scored, label, output))
    table = metrics.crosstab_with_totals(scored, "aspect", "predicted_polarity")
    return {"aspects": metrics.aspect_report(table), **reports}


def answer_ranges(spark: SparkSession, servers: str, source: str, sink: str, state: str):
    """Range messages of one topic in, recommendation messages to another."""
    writer = streams.range_stream(
        readers.read_topic(spark, servers, source),
        schemas.RANGE_MESSAGE,
        state,
        place="business_id",
        **writers.topic_sink_options(servers, sink),
    )
    return streams.with_trigger(writer).start()


def answer_ratings(
    spark: SparkSession,
    servers: str,
    source: str,
    ratings: DataFrame,
    sims: LookupTable,
    store: str,
    state: str,
):
    """Rating messages of a topic in, the current list of each user in a store; returns both running streams."""
    messages = readers.read_topic(spark, servers, source)
    lists = streams.rating_stream(
        messages, ratings, sims, streams.recommendation_store(spark, store), f"{state}/lists"
    )
    rejects = streams.reject_stream(messages, f"{store}/rejects", f"{state}/rejects")
    return streams.with_trigger(lists).start(), streams.with_trigger(rejects).start()


def _options(text: str) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in text.split(",") if pair)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="savormap.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def add(name: str, *arguments: str) -> None:
        job = jobs.add_parser(name)
        for argument in arguments:
            job.add_argument(f"--{argument}", required=True)
        job.add_argument("--format", default="parquet")
        job.add_argument("--options", type=_options, default=_NO_OPTIONS, help="key=value,…")

    add("publish-range", "places", "photos", "city", "lat", "lon", "km", "user")
    add("city-reviews", "places", "reviews", "city", "km")
    add("factors", "reviews", "users-out", "places-out")
    add("recommend-lists", "reviews", "users-out", "places-out", "similar-out", "lists-out", "chain-out")
    add("rank-range", "messages", "users", "places", "out")
    add("tune", "reviews", "out")
    add("review-report", "labelled", "out")
    add("answer-ranges", "servers", "source", "sink", "state")
    add("answer-ratings", "servers", "source", "ratings", "sims", "store", "state")
    return parser


def main(arguments: Sequence[str] | None = None) -> None:
    """Run one job to its end, streams until stopped; stored steps go when it ends, failed or not."""
    a = _parser().parse_args(arguments)
    spark = build_session(f"savormap-{a.job}")
    try:
        run_job(spark, a)
    finally:
        remove_scratch(spark)


def run_job(spark: SparkSession, a: argparse.Namespace) -> None:
    """The job that the arguments name."""
    table = lambda path: readers.read_parquet(spark, path)
    if a.job == "publish-range":
        where = a.city, float(a.lat), float(a.lon), float(a.km), a.user
        publish_range(table(a.places), table(a.photos), *where, a.format, **a.options)
    elif a.job == "city-reviews":
        places = readers.read_csv(spark, a.places, schemas.PLACES)
        reviews = readers.read_csv(spark, a.reviews, schemas.REVIEWS)
        store_city_reviews(places, reviews, a.city, float(a.km), a.format, **a.options)
    elif a.job == "factors":
        outputs = {**a.options, "path": a.users_out}, {**a.options, "path": a.places_out}
        store_factors(table(a.reviews), a.format, *outputs)
    elif a.job == "recommend-lists":
        outputs = ({**a.options, "path": p} for p in (a.users_out, a.places_out, a.similar_out, a.lists_out))
        store_factors(table(a.reviews), a.format, *outputs, chain=a.chain_out)
    elif a.job == "rank-range":
        messages = readers.read_json(spark, a.messages, schemas.RANGE_MESSAGE)
        writers.append_json(rank_range(messages, table(a.users), table(a.places)), a.out)
    elif a.job == "tune":
        everything, best = tune_factors(table(a.reviews))
        everything.withColumn("best", F.lit(False)).unionByName(best.withColumn("best", F.lit(True))).write.mode(
            "overwrite"
        ).json(a.out)
    elif a.job == "review-report":
        labelled = readers.read_csv(spark, a.labelled, schemas.LABELLED_TEXT)
        for name, report in review_report(labelled).items():
            writers.write_csv(report, f"{a.out}/{name}")
    elif a.job == "answer-ranges":
        answer_ranges(spark, a.servers, a.source, a.sink, a.state).awaitTermination()
    else:
        answer_ratings(
            spark, a.servers, a.source, table(a.ratings), similar_lookup(spark, a.sims), a.store, a.state
        )
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
