"""Rating preparation, matrix factorisation, and candidate recommendation."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from savormap.functions.vectors import dot, log_factor
from savormap.operators.metrics import MAP_DEPTH, average_precision, mean_average_precision, rmse
from savormap.operators.products import top_products
from savormap.operators.ranking import SIMILAR_ITEMS, USER_RECOMMENDATIONS, top_per_group
from savormap.operators.shaping import dense_index, known_rows, one_per_text
from savormap.operators.similarity import SCORE_THRESHOLD
from savormap.skew import LIST_ROWS, gather_lists
from savormap.storage import cut_lineage, free_shuffles, shared_root

# Production setting and tuning grids.
RANK, REGULARISATION, ITERATIONS = 50, 0.01, 8
GRID_RANKS = (10, 20, 30, 40)
GRID_REGULARISATIONS = (0.05, 0.03, 0.01)
GRID_ITERATIONS = (15, 20, 25, 30)
LIKED_ABOVE = 3.0
BLOCKS = 10  # user and item blocks of a factorisation, at least
BLOCK_RATINGS = 4_000_000  # ratings that a block is meant to have at most
SEED = 42
HELD_ITEMS = 1_000  # rated items of a user that are carried beside each of the user's events
CANDIDATE_PAGES = 16  # pages, by the candidate's hash, that a user's candidates come in
CHECKPOINT_EVERY = 1  # iterations of a factorisation after which its shuffles are dropped
PLACE_PARTS = 64  # parts, by the place's hash, in which places in range meet vectors


def indexed(
    ratings: DataFrame, users: DataFrame, items: DataFrame, user: str = "user_id", item: str = "item_id"
) -> DataFrame:
    """Ratings with the dense indexes joined on; the index tables grow, so no broadcast is forced."""
    return ratings.join(users, user).join(items, item)


def prepare_ratings(
    reviews: DataFrame,
    user: str = "user_id",
    item: str = "item_id",
    stars: str = "stars",
    text: str | None = "text",
    key: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Deduplicate texts, keep complete distinct ratings, index both ids.

    Returns (ratings with user_idx, item_idx, score, stored; user index; item index).
    Of equal texts the complete row with the lowest ``key`` counts; without
    ``text`` no key is needed.
    """
    if text:
        if key is None:
            raise ValueError("equal texts need a row key to choose by")
        complete = known_rows(reviews, user, item, stars)
        reviews = one_per_text(complete, text, key, [user, item, stars, key])
    plain = cut_lineage(
        known_rows(reviews.select(user, item, stars), user, item, stars).distinct()
    )
    users, items = dense_index(plain, user, "user_idx"), dense_index(plain, item, "item_idx")
    numbered = indexed(plain, users, items, user, item).select(
        F.col("user_idx").cast("int").alias("user_idx"),
        F.col("item_idx").cast("int").alias("item_idx"),
        F.col(stars).cast("double").alias("score"),
    )
    return cut_lineage(numbered), users, items


def blocks_for(ratings: DataFrame) -> int:
    """Blocks of a factorisation; ``ratings`` are counted, so hand in a stored table, not a long plan."""
    return max(BLOCKS, math.ceil(ratings.count() / BLOCK_RATINGS))


def fit_factors(
    ratings: DataFrame,
    rank: int = RANK,
    regularisation: float = REGULARISATION,
    iterations: int = ITERATIONS,
    seed: int = SEED,
    blocks: int | None = None,
) -> ALSModel:
    """Explicit-feedback ALS over (user_idx, item_idx, score).

    ``blocks`` is the number of user and of item blocks, by default as ``blocks_for`` says.
    A task holds a block's ratings and the factors of all that these name, so tables beyond
    ``BLOCKS`` x ``BLOCK_RATINGS`` ratings take more blocks; more factors are shuffled then. Starting
    factors are drawn per block, so the same data, seed and blocks give the same model.

    An iteration shuffles every factor to up to ``blocks`` blocks. Item factors are
    checkpointed after each, whereupon ALS drops the shuffles before them at once, so the
    disk holds those of one iteration, however many there are.
    """
    shared_root(ratings.sparkSession)  # where ALS cuts its own lineage
    blocks = blocks or blocks_for(ratings)
    return ALS(
        userCol="user_idx",
        itemCol="item_idx",
        ratingCol="score",
        rank=rank,
        regParam=regularisation,
        maxIter=iterations,
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=CHECKPOINT_EVERY,
        coldStartStrategy="drop",
    ).fit(ratings)


def factor_tables(
    model: ALSModel,
    users: DataFrame,
    items: DataFrame,
    user: str = "user_id",
    item: str = "item_id",
) -> tuple[DataFrame, DataFrame]:
    """User and item feature vectors under their original ids."""

    def named(factors: DataFrame, index: DataFrame, position: str, key: str, name: str) -> DataFrame:
        vectors = factors.select(
            F.col("id").cast("long").alias(position),
            F.col("features").cast("array<double>").alias(name),
        )
        return vectors.join(index, position).select(key, name)

    return (
        named(model.userFactors, users, "user_idx", user, "user_feature"),
        named(model.itemFactors, items, "item_idx", item, "item_feature"),
    )


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predicted rating of given pairs; pairs with an unknown side are dropped."""
    return model.transform(pairs)


def recommend_all(
    model: ALSModel,
    users: DataFrame,
    items: DataFrame,
    n: int = USER_RECOMMENDATIONS,
    user: str = "user_id",
    item: str = "item_id",
) -> DataFrame:
    """Each user's ``n`` best items with a positive score, under original ids."""
    best = best_items(model, n)
    return best.join(users, "user_idx").join(items, "item_idx").select(user, item, "score", "position")


def best_items(model: ALSModel, n: int = USER_RECOMMENDATIONS) -> DataFrame:
    """Each user's ``n`` best items with a positive score: user_idx, item_idx, score, position."""
    vectors = lambda factors: factors.select(
        F.col("id").cast("long").alias("id"), F.col("features").alias("vec")
    )
    return top_products(vectors(model.userFactors), vectors(model.itemFactors), n).select(
        F.col("left").alias("user_idx"), F.col("right").alias("item_idx"), "score", "position"
    )


def scored_lists(
    scored: DataFrame,
    key: str = "user_id",
    item: str = "item_id",
    score: str = "score",
    rows: int = LIST_ROWS,
) -> DataFrame:
    """Lists of (item, score) per key, best first, in pages."""
    return gather_lists(
        scored, [key], [item, score], "recs", [-F.col(score), F.col(item)], rows
    )


def whole_lists(
    scored: DataFrame, key: str, item: str = "item_id", score: str = "score", rows: int = LIST_ROWS
) -> DataFrame:
    """The pages of ``scored_lists`` by one shuffle, with nothing stored, for lists that each fit a task.

    An entry takes 16 bytes and a few words of Spark's. So this suits lists no longer than a table of which all pairs are compared.
    """
    entry = F.struct((-F.col(score)).alias("_order"), F.col(item).alias("_item"))
    # Rows go to their key before lists are begun, since a row is smaller than the list of one.
    lists = scored.repartition(key).groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_list"))
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.size("_list") - 1) / F.lit(rows)).cast("long"))
    page = F.slice("_list", (F.col("part") * rows + 1).cast("int"), rows)
    recs = F.transform(page, lambda e: F.struct(e["_item"].alias(item), (-e["_order"]).alias(score)))
    return lists.withColumn("part", F.explode(parts)).select(key, "part", recs.alias("recs"))


def grid_search(
    train: DataFrame,
    test: DataFrame,
    ranks: Sequence[int] = GRID_RANKS,
    regularisations: Sequence[float] = GRID_REGULARISATIONS,
    iterations: Sequence[int] = GRID_ITERATIONS,
    parallel: int = 2,
    seed: int = SEED,
    blocks: int | None = None,
) -> DataFrame:
    """Error and precision of every setting: rank, regularisation, iterations, rmse, map.

    Both sides are stored once; ``parallel`` fits share the cluster. What a setting has
    shuffled is dropped as soon as it is measured.
    """
    train, test = cut_lineage(train), cut_lineage(test)
    settings = list(product(ranks, regularisations, iterations))
    blocks = blocks or blocks_for(train)

    def measure(setting: tuple[int, float, int]) -> tuple[int, float, int, float, float]:
        rank, reg, steps = setting
        model = fit_factors(train, rank, reg, steps, seed, blocks)
        error = rmse(predict(model, test), "score", "prediction").first()["rmse"]
        listed = best_items(model, MAP_DEPTH)
        each = average_precision(listed, test, user="user_idx", item="item_idx")
        precision = mean_average_precision(each).first()["map"]
        del model, listed, each
        free_shuffles(train.sparkSession)
        return rank, reg, steps, error, precision

    with ThreadPoolExecutor(parallel) as pool:
        rows = list(pool.map(measure, settings))
    return train.sparkSession.createDataFrame(
        rows, "rank int, regularisation double, iterations int, rmse double, map double"
    )


def unseen_candidates(
    events: DataFrame,
    sims: DataFrame | Callable[[int | None], DataFrame],
    rated: DataFrame,
    n: int = SIMILAR_ITEMS,
    user: str = "user_id",
    item: str = "item_id",
) -> DataFrame:
    """For each distinct (user, item) event, the ``n`` most similar items the user has not rated.

    Columns: user, item, candidate, sim, position. Items without similarities
    give no rows. Each list is ranked once; of the items a user has rated only
    so many can stand before the ``n`` wanted ones, so no more than ``n`` plus
    their number of a list meets an event. An event carries its user's rated items
    to the item's list and leaves with its ``n`` candidates; only users with more than
    ``HELD_ITEMS`` rated items have a row for every entry they look at.

    ``sims`` may be a function of the number of entries of a list that any event can look at
    (None: more than ``n`` and ``HELD_ITEMS``), so that it needn't make, or send on, those behind them.
    """
    asked = events.select(user, item).distinct()
    seen = rated.join(asked.select(user).distinct(), user, "left_semi").select(
        user, F.col(item).alias("candidate")
    ).distinct()
    known = seen.groupBy(user).agg(F.count(F.lit(1)).alias("_known"))
    light = F.col("_known") <= HELD_ITEMS
    most = known.agg(F.max(F.when(light, F.col("_known"))).alias("held"), F.max("_known").alias("all")).first()
    if callable(sims):
        sims = sims(n + (most["all"] or 0) if (most["all"] or 0) <= HELD_ITEMS else None)
    held = seen.join(known.where(light), user).groupBy(user).agg(
        F.collect_list("candidate").alias("_seen"), F.first("_known").alias("_known")
    )
    few = (
        asked.join(held, user, "left")
        .join(known.where(~light).select(user), user, "left_anti")
        .withColumn("_deepest", F.coalesce("_known", F.lit(0)) + n)
    )
    order = Window.partitionBy("a").orderBy(F.col("sim").desc(), "b")
    wanted = sims.join(asked.select(F.col(item).alias("a")).distinct(), "a", "left_semi")
    ranked = wanted.withColumn("_rank", F.row_number().over(order)).select(
        F.col("a").alias(item), F.col("b").alias("candidate"), "sim", "_rank"
    )
    entry = F.struct("_rank", "candidate", "sim")
    lists = ranked.where(F.col("_rank") <= n + (most["held"] or 0)).groupBy(item).agg(
        F.sort_array(F.collect_list(entry)).alias("_list")
    )
    unseen = F.filter(
        F.slice("_list", F.lit(1), F.col("_deepest").cast("int")),
        lambda e: ~F.coalesce(F.array_contains("_seen", e["candidate"]), F.lit(False)),
    )
    found = (
        few.join(lists, item)
        .select(user, item, F.posexplode(F.slice(unseen, 1, n)).alias("_at", "_entry"))
        .select(user, item, "_entry.candidate", "_entry.sim", (F.col("_at") + 1).alias("position"))
    )
    if (most["all"] or 0) <= HELD_ITEMS:
        return found
    many = asked.join(known.where(~light), user).withColumn("_deepest", F.col("_known") + n)
    near = many.join(ranked, item).where("_rank <= _deepest").drop("_known", "_deepest", "_rank")
    fresh = near.join(seen, [user, "candidate"], "left_anti")
    rest = top_per_group(fresh, [user, item], [F.col("sim").desc(), F.col("candidate")], n)
    return found.unionByName(rest.select(user, item, "candidate", "sim", "position"))


def candidate_scores(
    candidates: DataFrame,
    recent: DataFrame,
    sims: DataFrame,
    threshold: float = SCORE_THRESHOLD,
    user: str = "user_id",
    item: str = "item_id",
    stars: str = "stars",
) -> DataFrame:
    """Score of each (user, candidate) from the user's recent ratings of similar items.

    Mean of similarity × rating, plus log10 of the number of ratings above 3,
    minus log10 of the number of the others (both at least 1). Each of a user's recent
    ratings takes the user's candidates, as pages of ids, to the similarities of its item, and
    only those that are found there become rows; a candidate with none above the threshold
    has no score. The sums combine before the shuffle.
    """
    page = lambda name: F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(CANDIDATE_PAGES)).alias("_page")
    edges = sims.where(F.col("sim") > threshold).select(
        F.col("b").alias(item), F.col("a").alias("candidate"), "sim", page("a")
    )
    wanted = candidates.groupBy(user, page("candidate")).agg(F.collect_set("candidate").alias("_wanted"))
    liked = F.col(stars) > LIKED_ABOVE
    return (
        wanted.join(recent.select(user, item, stars), user)
        .join(edges, [item, "_page"])
        .where(F.array_contains("_wanted", F.col("candidate")))
        .groupBy(user, "candidate")
        .agg(
            F.avg(F.col("sim") * F.col(stars)).alias("_mean"),
            F.count_if(liked).alias("_up"),
            F.count_if(~liked).alias("_down"),
        )
        .select(
            user,
            "candidate",
            (
                F.col("_mean")
                + log_factor(F.greatest(F.col("_up"), F.lit(1)))
                - log_factor(F.greatest(F.col("_down"), F.lit(1)))
            ).alias("score"),
        )
    )


def rank_by_affinity(
    in_range: DataFrame,
    user_features: DataFrame | None = None,
    place_features: DataFrame | None = None,
    user: str = "user_id",
    place: str = "place_id",
) -> DataFrame:
    """Places in range with the dot product of user and place vectors; unknown ids give no rows.

    Without a table of features the rows hold ``user_feature`` or ``item_feature`` already: there
    are far more places in range than requests and places, so it pays to join the vectors to those.
    """
    rows = in_range if place_features is None else in_range.join(place_features, place)
    rows = rows if user_features is None else rows.join(user_features, user)
    return rows.withColumn("affinity", dot(F.col("user_feature"), F.col("item_feature"))).drop("user_feature", "item_feature")


def with_vectors(
    in_range: DataFrame,
    user_features: DataFrame,
    place_features: DataFrame,
    user: str = "user_id",
    place: str = "place_id",
    parts: int = PLACE_PARTS,
) -> DataFrame:
    """Places in range with ``user_feature`` and ``item_feature`` beside them; unknown ids give no rows.

    Rows are shuffled once, without vectors, to the part of their place. There they meet the vectors of that
    part's places and, once each, of the users who ask for them, so no vector is shuffled or sorted for each
    row. A task holds the vectors of its part: name more ``parts`` for larger tables. ``in_range`` is read
    twice, so keep it stored.
    """
    part = F.pmod(F.xxhash64(place), F.lit(parts)).cast("int")
    dealt = lambda rows: rows.repartitionById(parts, F.col("_part"))
    rows = in_range.withColumn("_part", part)
    users = rows.select("_part", user).distinct().join(user_features, user)
    places = place_features.withColumn("_part", part)
    beside = dealt(rows).join(dealt(users).hint("shuffle_hash"), ["_part", user])
    return beside.join(dealt(places).hint("shuffle_hash"), ["_part", place]).drop("_part")
