"""Candidate scores, precision, factorisation and tuning."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from savormap.operators import metrics, products, ranking, recommend
from savormap.operators.products import met_share, top_products
from savormap.plans import recommend_queries
from tests.conftest import plan_of

SIMS = "a long, b long, sim double"


def test_candidate_score_by_hand(spark):
    sims = spark.createDataFrame(
        [(10, 1, 0.9), (10, 2, 0.8), (10, 3, 0.75), (10, 4, 0.95), (11, 1, 0.7), (12, 9, 0.9)], SIMS
    )
    recent = spark.createDataFrame(
        [(7, 1, 5.0), (7, 2, 4.0), (7, 3, 3.5), (7, 4, 3.0)], "user_id long, item_id long, stars double"
    )
    wanted = spark.createDataFrame([(7, 10), (7, 11), (7, 12)], "user_id long, candidate long")
    rows = recommend.candidate_scores(wanted, recent, sims).collect()
    assert [r["candidate"] for r in rows] == [10]  # 11 only reaches 0.7 itself, 12 knows no recent item
    mean = (0.9 * 5 + 0.8 * 4 + 0.75 * 3.5 + 0.95 * 3) / 4
    assert rows[0]["score"] == pytest.approx(mean + math.log10(3) - math.log10(1))


def test_unseen_candidates(spark):
    sims = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.8), (1, 4, 0.8), (1, 5, 0.7)], SIMS)
    events = spark.createDataFrame([(7, 1), (7, 1), (8, 99)], "user_id long, item_id long")
    rated = spark.createDataFrame([(7, 2), (9, 3)], "user_id long, item_id long")
    rows = recommend.unseen_candidates(events, sims, rated, n=2).orderBy("position").collect()
    assert [(r["user_id"], r["candidate"]) for r in rows] == [(7, 3), (7, 4)]


def test_candidates_say_how_much_of_a_list_they_need(spark, monkeypatch):
    sims = [(1, b, 1 - b / 100) for b in range(2, 60)]
    events = spark.createDataFrame([(7, 1), (8, 1)], "user_id long, item_id long")
    rated = spark.createDataFrame([(7, 2), (7, 3), (8, 5), (9, 4), (9, 6), (9, 7)], "user_id long, item_id long")
    asked = []

    def best(depth):
        asked.append(depth)
        return spark.createDataFrame(sims[:depth], SIMS)

    answer = lambda of: sorted(map(tuple, recommend.unseen_candidates(events, of, rated, n=3).collect()))
    whole = answer(spark.createDataFrame(sims, SIMS))
    assert answer(best) == whole and asked == [5]
    monkeypatch.setattr(recommend, "HELD_ITEMS", 1)
    assert answer(best) == whole and asked == [5, None]


def test_recent_ratings_keep_the_latest(spark):
    rows = spark.createDataFrame(
        [(1, i, float(i), i // 2) for i in range(50)], "user_id long, item_id long, stars double, ts long"
    )
    got = ranking.recent_ratings(rows, k=3).orderBy("position").collect()
    assert [r["item_id"] for r in got] == [48, 49, 46]


def ap(spark, predicted, actual, k, users=None):
    pred = spark.createDataFrame([(1, p, n + 1) for n, p in enumerate(predicted)], "user_id int, item_id string, position int")
    act = spark.createDataFrame([(1, a) for a in actual], "user_id int, item_id string")
    rows = metrics.average_precision(pred, act, k, users=users).collect()
    return rows[0]["average_precision"]


def test_average_precision_by_hand(spark):
    everyone = spark.createDataFrame([(1,)], "user_id int")
    assert ap(spark, "abc", "aac", 3) == pytest.approx((1 / 1 + 2 / 3) / 2)
    assert ap(spark, "abc", "", 3, everyone) == 1.0
    assert ap(spark, "xyz", "abc", 3) == 0.0
    assert ap(spark, "abcd", "abcd", 2) == pytest.approx(1.0)
    assert ap(spark, "xa", "a", 1) == 0.0


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(1)
    users, items = rng.normal(size=(60, 3)), rng.normal(size=(40, 3))
    score = 3 + users @ items.T
    rows = [(f"u{u}", f"i{i}", float(score[u, i])) for u in range(60) for i in range(40) if rng.random() < 0.6]
    return spark.createDataFrame(rows, "user_id string, item_id string, stars double")


def test_factors_beat_the_mean(spark, planted):
    numbered, users, items = recommend.prepare_ratings(planted, text=None)
    assert numbered.count() == planted.count()
    train, test = numbered.randomSplit([0.8, 0.2], 3)
    model = recommend.fit_factors(train, rank=4, regularisation=0.05, iterations=8)
    error = metrics.rmse(recommend.predict(model, test), "score", "prediction").first()["rmse"]
    mean = train.agg(F.avg("score")).first()[0]
    plain = test.agg(F.sqrt(F.avg(F.pow(F.col("score") - mean, 2)))).first()[0]
    assert error < 0.5 * plain

    of_users, of_items = recommend.factor_tables(model, users, items)
    assert of_users.count() == 60 and of_items.count() == 40
    assert set(of_items.columns) == {"item_id", "item_feature"}

    recs = recommend.recommend_all(model, users, items, n=5)
    assert recs.where("score <= 0").count() == 0
    assert recs.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 5
    lists = recommend.scored_lists(recs).collect()
    assert all([r["score"] for r in x["recs"]] == sorted((r["score"] for r in x["recs"]), reverse=True) for x in lists)

    # A pair with an unknown side is dropped, a repeated test row counts once.
    pairs = spark.createDataFrame([(0, 0, 3.0), (0, 0, 4.0), (10_000, 0, 3.0)], "user_idx int, item_idx int, score double")
    assert recommend.predict(model, pairs).count() == 2


def test_shuffles_of_past_iterations_are_dropped(spark, planted):
    """What a fitted model still rests on doesn't grow with its iterations."""
    numbered, _, _ = recommend.prepare_ratings(planted, text=None)
    kept = [
        recommend.fit_factors(numbered, rank=2, iterations=n).userFactors._jdf.queryExecution().toRdd().toDebugString().count("ShuffledRDD")
        for n in (2, 6)
    ]
    assert kept[0] == kept[1]


@pytest.mark.parametrize("blocks", [(7, 9), (10_000, 10_000)])
def test_top_products_match_brute_force(spark, blocks):
    rng = np.random.default_rng(2)
    left, right = rng.integers(-3, 4, size=(40, 3)), rng.integers(-3, 4, size=(60, 3))
    frame = lambda m: spark.createDataFrame(
        [(i + 100, [float(x) for x in v]) for i, v in enumerate(m)], "id long, vec array<float>"
    ).repartition(3)
    got = top_products(frame(left), frame(right), 5, *blocks).collect()
    for i, v in enumerate(left):
        scores = sorted((-float(v @ w), j + 100) for j, w in enumerate(right) if v @ w > 0)[:5]
        mine = sorted((r for r in got if r["left"] == i + 100), key=lambda r: r["position"])
        assert [(-r["score"], r["right"]) for r in mine] == scores


def test_large_tables_take_more_blocks(spark, planted, monkeypatch):
    """A block's ratings and the factors they name have to fit a task; small tables keep their blocks."""
    numbered, _, _ = recommend.prepare_ratings(planted, text=None)
    assert numbered.inputFiles()  # stored, so counting it is cheap
    blocks = lambda: recommend.fit_factors(numbered, rank=2, iterations=1).userFactors.rdd.getNumPartitions()
    assert blocks() == recommend.BLOCKS
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", math.ceil(numbered.count() / 13))
    assert blocks() == 13


def test_best_items_agree_with_the_model(spark, planted):
    numbered, _, _ = recommend.prepare_ratings(planted, text=None)
    model = recommend.fit_factors(numbered, rank=3, iterations=3)
    ours = {(r["user_idx"], r["item_idx"]): r["score"] for r in recommend.best_items(model, 4).collect()}
    listed = model.recommendForAllUsers(4).select("user_idx", F.explode("recommendations").alias("r")).collect()
    theirs = {(r["user_idx"], r["r"]["item_idx"]): r["r"]["rating"] for r in listed if r["r"]["rating"] > 0}
    assert ours.keys() == theirs.keys()
    assert all(ours[k] == pytest.approx(theirs[k], rel=1e-4) for k in ours)


def test_grid_reports_every_setting(planted):
    numbered, _, _ = recommend.prepare_ratings(planted, text=None)
    train, test = numbered.randomSplit([0.8, 0.2], 3)
    table = recommend.grid_search(train, test, (2, 4), (0.05,), (3,)).cache()
    assert table.count() == 2
    best = ranking.best_row(table, "rmse", ["rank", "regularisation", "iterations"]).first()
    assert best["rmse"] == table.agg(F.min("rmse")).first()[0]
    assert len(recommend.GRID_RANKS) * len(recommend.GRID_REGULARISATIONS) * len(recommend.GRID_ITERATIONS) == 48


def test_preparation_drops_incomplete_rows(spark):
    reviews = spark.createDataFrame(
        [(2, "a", "x", 4.0, "t1"), (1, "b", "x", 3.0, "t1"), (3, None, "y", 1.0, "t2"), (4, "a", "y", None, "t3"), (5, "a", "x", 4.0, "t4")],
        "key int, user_id string, item_id string, stars double, text string",
    )
    numbered, users, items = recommend.prepare_ratings(reviews, key="key")
    assert sorted(map(tuple, numbered.collect())) == [(0, 0, 4.0), (1, 0, 3.0)]
    assert sorted(r["user_id"] for r in users.collect()) == ["a", "b"]


def test_affinity_needs_both_sides(spark):
    found = spark.createDataFrame([("u", 1), ("u", 2), ("nobody", 1)], "user_id string, place_id long")
    users = spark.createDataFrame([("u", [1.0, 2.0])], "user_id string, user_feature array<double>")
    places = spark.createDataFrame([(1, [3.0, 0.5])], "place_id long, item_feature array<double>")
    rows = recommend.rank_by_affinity(found, users, places).collect()
    assert [(r["user_id"], r["place_id"], r["affinity"]) for r in rows] == [("u", 1, 4.0)]


def test_affinity_of_rows_that_hold_their_vectors(spark):
    """Pairs with both vectors beside them need no join and no shuffle."""
    rows = spark.createDataFrame(
        [("u", 1, [1.0, 2.0], [3.0, 0.5])], "user_id string, place_id long, user_feature array<double>, item_feature array<double>"
    )
    ranked = recommend.rank_by_affinity(rows)
    assert [tuple(r) for r in ranked.collect()] == [("u", 1, 4.0)]
    assert "Exchange" not in plan_of(ranked) and "Join" not in plan_of(ranked)


def test_places_in_range_meet_vectors_without_a_shuffle(spark):
    """They are shuffled once, without vectors, and not sorted (operators stand above what they read)."""
    found = spark.range(400).selectExpr("concat('u', id % 7) AS user_id", "id % 31 AS place_id", "id AS n")
    users = spark.range(9).selectExpr("concat('u', id) AS user_id", "array(id / 2, 1.0D) AS user_feature")
    places = spark.range(40).selectExpr("id AS place_id", "array(id / 4, -1.0D) AS item_feature")
    beside = recommend.with_vectors(found, users, places, parts=4)
    assert sorted(map(tuple, recommend.rank_by_affinity(beside).select("n", "user_id", "place_id", "affinity").collect())) == [
        (n, f"u{n % 7}", n % 31, n % 7 / 2 * (n % 31) / 4 - 1) for n in range(400)
    ]
    tree = plan_of(beside).split("\n\n")[0]
    lines = tree[: tree.index("Exchange")].splitlines()
    assert sum("ShuffledHashJoin" in line for line in lines) == 2 and not any("Sort " in line for line in lines)


def test_candidates_of_users_with_many_and_few_ratings(spark, monkeypatch):
    """Users whose rated items fit beside an event, and others; ties, unknown users, items without similarities."""
    rng = np.random.default_rng(4)
    pairs = [(a, b, round(float(rng.random()), 1)) for a in range(12) for b in range(12) if a != b]
    seen = {u: sorted(rng.choice(12, size=u, replace=False).tolist()) for u in range(1, 11)}
    asked = [(u, i) for u in range(12) for i in (0, 5, 99)]
    events = spark.createDataFrame(asked, "user_id long, item_id long")
    rated = spark.createDataFrame([(u, i) for u, found in seen.items() for i in found], "user_id long, item_id long")
    want = set()
    for u, i in asked:
        fresh = sorted((-s, b) for a, b, s in pairs if a == i and b not in seen.get(u, []))[:3]
        want |= {(u, i, b, -s, n) for n, (s, b) in enumerate(fresh, 1)}
    for held in (0, 4, 1_000):
        monkeypatch.setattr(recommend, "HELD_ITEMS", held)
        got = recommend.unseen_candidates(events, spark.createDataFrame(pairs, SIMS), rated, n=3)
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_only_similar_candidates_become_rows(spark):
    """Two thousand candidates and twenty recent ratings: two pairs are similar, and no other is shuffled."""
    wanted = spark.range(2_000).selectExpr("7L AS user_id", "id AS candidate")
    recent = spark.range(20).selectExpr("7L AS user_id", "id + 5000 AS item_id", "CAST(id % 5 + 1 AS DOUBLE) AS stars")
    sims = spark.createDataFrame([(3, 5001, 0.9), (1999, 5004, 0.8), (2500, 5004, 0.9), (4, 6000, 0.9)], SIMS)
    scores = recommend.candidate_scores(wanted, recent, sims)
    assert sorted((r["candidate"], round(r["score"], 9)) for r in scores.collect()) == [(3, 1.8), (1999, 4.0)]
    scan, met = scores._jdf.queryExecution().executedPlan(), []
    nodes = [scan.executedPlan() if hasattr(scan, "executedPlan") else scan]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if "Join" in name:
            met.append(node.metrics().apply("numOutputRows").value())
        inner = [node.plan()] if "QueryStage" in name else []
        kids = node.children()
        nodes += inner + [kids.apply(i) for i in range(kids.size())]
    assert met and max(met) <= 20 * recommend.CANDIDATE_PAGES


def test_recent_items_meet_one_row_of_their_list(spark, monkeypatch):
    """Items rated once, twice, and without similar ones; the table looked up has a row per item."""
    sims = spark.createDataFrame([(1, b, b / 10) for b in range(2, 9)] + [(2, 1, 0.2)], SIMS)
    rated = spark.createDataFrame(
        [(7, 1, 5.0, 1, 1, 1), (7, 1, 4.0, 2, 2, 1), (7, 2, 4.0, 3, 3, 1), (8, 3, 1.0, 1, 4, 1)],
        "user_id long, item_id long, stars double, ts long, l_orderkey long, l_linenumber int",
    )
    met, join = [], recommend_queries.lookup_join
    monkeypatch.setattr(recommend_queries, "_sims", lambda spark, sf: sims)
    monkeypatch.setattr(recommend_queries.views, "vector_ratings", lambda spark, sf: rated)
    monkeypatch.setattr(recommend_queries, "lookup_join", lambda df, lookup, on: met.append(lookup.count()) or join(df, lookup, on))
    got = recommend_queries.similarity_of_recent_items(spark, "")
    assert sorted(tuple(r) for r in got.collect()) == [(7, 1, 14, 0.8), (7, 2, 1, 0.2)] and met == [2]


def test_float_vectors_travel_as_floats(spark, monkeypatch):
    """Half the bytes in a block, columns met a chunk at a time, and the same best products."""
    rng = np.random.default_rng(9)
    side = rng.integers(-3, 4, size=(60, 5))
    floats = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(side)], "id long, vec array<float>")
    sizes = products._packed(floats).select(F.octet_length("vec").alias("n")).distinct().collect()
    assert [r["n"] for r in sizes] == [4 * 5]
    monkeypatch.setattr(products, "_CHUNK", 7)
    ids, least = np.arange(60)[::-1].copy(), np.zeros(60)
    rows, columns, scores = products._best(side.astype(float), side.astype(float), ids, 4, least)
    for i, of in enumerate(side @ side.T):
        order = [j for j in np.lexsort((ids, -of)) if of[j] > 0][:4]
        assert columns[rows == i].tolist() == order and scores[rows == i].tolist() == of[order].tolist()


def _vectors(spark, first, vectors):
    return spark.createDataFrame([(first + i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vec array<double>")


@pytest.mark.parametrize("blocks", [(64, 50), (100_000, 100_000)])
def test_pruned_products_match_brute_force(spark, blocks):
    """Lengths that differ widely, ties, zero vectors, null ones: the same best, far fewer products."""
    rng = np.random.default_rng(3)
    left = rng.normal(0, 1, (300, 8)) + 0.7
    right = (rng.normal(0, 1, (900, 8)) + 0.5) * rng.lognormal(0, 1.2, 900)[:, None]
    right[100:120] = right[400:420]  # equal products, the lower id wins
    left[7], right[11] = 0, 0
    ours, theirs = _vectors(spark, 0, left), _vectors(spark, 1_000, right)
    theirs = theirs.unionByName(spark.createDataFrame([(9_999, None)], theirs.schema))
    scores = left @ right.T
    want = set()
    for i, row in enumerate(scores):
        order = [j for j in np.lexsort((np.arange(900), -row)) if row[j] > 0][:10]
        want |= {(i, 1_000 + j, p) for p, j in enumerate(order, 1)}
    got = {(r["left"], r["right"], r["position"]) for r in top_products(ours, theirs, 10, *blocks).collect()}
    assert got == want
    assert met_share(ours, theirs, 10) < 0.6
    assert top_products(ours, theirs.limit(0), 10).count() == 0 == top_products(ours.limit(0), theirs, 10).count()


def test_vectors_of_one_length_are_all_met(spark):
    rng = np.random.default_rng(5)
    unit = rng.normal(0, 1, (200, 6))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    side = _vectors(spark, 0, unit)
    assert met_share(side, side, 3) > 0.9
    best = top_products(side, side, 3).where("position = 1").collect()
    assert len(best) == 200 and all(r["left"] == r["right"] for r in best)


@pytest.mark.parametrize("scale", [1e-160, 1.0, 1e150])
def test_products_that_single_precision_cannot_tell_apart(monkeypatch, scale):
    """Scores that differ by less than a float shows, lengths beyond a float's range, ties; few products are made in double."""
    rng = np.random.default_rng(6)
    a = rng.normal(size=(30, 8)) * scale
    b = np.ones((900, 8)) + rng.normal(scale=1e-9, size=(900, 8))
    b[:300] = rng.normal(size=(300, 8))
    b[500:520] = b[700:720]
    ids = rng.permutation(900)
    made = []
    exact = products.exact_products
    monkeypatch.setattr(products, "exact_products", lambda *of: made.append(len(of[2])) or exact(*of))
    rows, columns, scores = products._best(a, b, ids, 7, np.zeros(30))
    for i in range(30):
        of = np.einsum("ij,j->i", b, a[i])
        order = [j for j in np.lexsort((ids, -of)) if of[j] > 0][:7]
        assert scores[rows == i].tolist() == pytest.approx(of[order].tolist(), rel=1e-12)
        assert len(set(columns[rows == i].tolist())) == len(order)
    assert sum(made) < 30 * 900
    rows, columns, _ = products._best(a[:1], np.repeat(a[:1], 40, axis=0), ids[:40], 3, np.zeros(1))
    assert ids[columns].tolist() == sorted(ids[:40].tolist())[:3]


def test_small_bands_share_a_block():
    """Of bands of equal lengths a row sends on n products for each block, not for each band."""
    bands = products.Bands("length", [1.0, 2.0, 3.0, 4.0], [3, 3, 3, 9, 3], [0.0] * 5, [9.0] * 5, [1, 1, 1, 2, 1], together=6)
    assert bands.starts == [0, 0, 1, 2, 4]
    assert products.Bands("length", [1.0], [3, 3], [0.0] * 2, [9.0] * 2, [1, 1]).starts == [0, 1]


def test_whole_lists_are_the_pages_of_scored_lists(spark):
    """Ties, a page that is just full, a missing key; one shuffle."""
    rows = [(k, n, float(n * 7 % 5)) for k, size in ((1, 1), (2, 4), (3, 9), (None, 3)) for n in range(size)]
    scored = spark.createDataFrame(rows, "a long, b long, sim double").repartition(3)
    got = recommend.whole_lists(scored, "a", "b", "sim", rows=4)
    flat = lambda df: sorted((repr(r["a"]), r["part"], [tuple(e) for e in r["recs"]]) for r in df.collect())
    assert flat(got) == flat(recommend.scored_lists(scored, "a", "b", "sim", rows=4))
    lone = recommend.whole_lists(spark.range(9).selectExpr("id % 2 AS a", "id AS b", "1.0D AS sim"), "a", "b", "sim")
    assert plan_of(lone).split("\n\n")[0].count("Exchange") == 1


def test_lists_of_similar_vectors_shuffle_pairs_once(spark):
    """Above the task that multiplies, pairs are shuffled once, to the vector they are listed under."""
    from savormap.plans.recommend_queries import similar_vector_lists

    tree = plan_of(similar_vector_lists(spark, "/root/testdata/sf0.001")).split("\n\n")[0]
    assert "FlatMapGroupsInPandas" in tree and tree[: tree.index("FlatMapGroupsInPandas")].count("Exchange") == 1
