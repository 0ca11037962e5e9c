"""Text normalisation, vocabulary, classifiers, and report tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from savormap.functions import text
from savormap.functions.vectors import cosine, decided_class, star_of_scores
from savormap.operators import classify, metrics
from savormap.storage import cut_lineage

REVIEWS = [
    "I hated this, absolutely the worst",
    "Pretty disappointing. Waiter didn't even know what a Jameson and coke was.",
    "One of my favorite bars in Taipei. They're located in the same building.",
]


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


def test_contractions_in_order(spark):
    expand = text.expand_contractions
    assert one(spark, expand, "I won't, can't; he's") == "I will not, can not; he is"
    assert one(spark, expand, "didn't they're I'd we'll I've I'm Won't") == (
        "did not they are I would we will I have I am Wo not"
    )


def test_normalisation_steps(spark):
    normal = text.normal_text
    assert one(spark, normal, "Line\\rone\\nnext \\\"quoted\\\"") == "line one next quoted"
    assert one(spark, normal, "aba ABA Abc banana noon They food123bar") == "abc banana food bar"
    assert one(spark, normal, "") == "" and one(spark, normal, None) is None
    assert one(spark, normal, "THE they because   Pizza") == "pizza"
    path = lambda c: text.normal_text(c, "path")
    assert one(spark, path, "they stop words data root pizza") == "they pizza"
    with pytest.raises(ValueError):
        text.without_stop_words(F.col("t"), "other")


def test_decisions(spark):
    row = spark.sql(
        "SELECT array(0.4D, 0.3D, 0.3D) AS a, array(0.1D, 0.6D, 0.3D) AS b, array(0.5D, 0.5D) AS e,"
        "array(0.9D, 0.2D, 0.1D, -0.2D, -0.5D) AS c, array(0.0D, 0.0D) AS z"
    ).select(
        decided_class(F.col("a")), decided_class(F.col("b")), decided_class(F.col("e")),
        star_of_scores(F.col("c")), cosine(F.col("z"), F.col("z")),
    )
    assert tuple(row.first()) == (0, 1, 0, 1, None)


def test_vocabulary_is_limited_and_ordered(spark):
    rows = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["c", "a"]), (3, [])], "id int, tokens array<string>")
    table = classify.vocabulary(rows, words=2)
    assert [tuple(r) for r in table.orderBy("rank").collect()] == [("a", 2, 1), ("b", 2, 2)]
    assert sorted(map(tuple, classify.multi_hot(rows, table, "id").collect())) == [(1, 1), (1, 2), (2, 1)]
    vectors = classify.vectoriser(rows, words=2).transform(rows).orderBy("id").collect()
    assert [v["features"].toArray().tolist() for v in vectors] == [[1, 1], [1, 0], [0, 0]]


@pytest.mark.parametrize("algorithm", ["logistic", "perceptron"])
def test_classifier_beats_the_majority(spark, monkeypatch, algorithm):
    monkeypatch.setattr(classify, "HIDDEN_LAYERS", (8,))
    rng = np.random.default_rng(0)
    names = {"food": "tasty soup", "price": "cheap bill", "service": "friendly waiter"}
    rows = [
        (i, label, words.split() + [f"w{rng.integers(0, 20)}"])
        for i in range(90)
        for label, words in [list(names.items())[i % 3]]
    ]
    data = cut_lineage(spark.createDataFrame(rows, "id int, aspect string, tokens array<string>"))
    model = classify.fit_text_classifier(
        data.where("id < 60"), "aspect", algorithm=algorithm, classes=3, iterations=20
    )
    scored = classify.predict_labels(model, data.where("id >= 60"))
    assert scored.count() == 30
    assert scored.where("aspect = predicted").count() > 20
    assert {"probabilities", "predicted"} <= set(scored.columns)


def test_several_labels_share_features(spark):
    """As fitted apart; a row without one label still teaches the other."""
    rows = [(i, "ab"[i % 2], ["x", "y", None][i % 3], [f"l{i % 2}", f"m{i % 3}", f"n{i % 5}"]) for i in range(90)]
    data = spark.createDataFrame(rows, "id int, one string, two string, tokens array<string>")
    models = classify.fit_text_classifiers(data, ("one", "two"))
    both = {r["id"]: r for r in classify.predict_several(models, data).collect()}
    assert all(both[i]["predicted_one"] == one for i, one, _, _ in rows)
    assert all(both[i]["predicted_two"] == two for i, _, two, _ in rows if two)
    apart = classify.fit_text_classifier(data, "one")
    assert {r["id"]: r["predicted"] for r in classify.predict_labels(apart, data).collect()} == {
        i: r["predicted_one"] for i, r in both.items()
    }


def test_classifier_options_are_checked(spark):
    rows = spark.createDataFrame([("a", ["x"])], "l string, tokens array<string>")
    with pytest.raises(ValueError):
        classify.fit_text_classifier(rows, "l", algorithm="forest")
    with pytest.raises(ValueError):
        classify.fit_text_classifier(rows, "l", algorithm="perceptron")


def test_star_ratings_take_any_scorer(spark):
    def scorer(texts):
        return np.array([[5.0, 1, 1, 1, 1] if "worst" in t else [0, 0, 0, 1, 9.0] for t in texts])

    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*REVIEWS, None])], "id int, text string")
    stars = {r["id"]: r["stars"] for r in classify.star_ratings(rows, scorer).collect()}
    assert stars == {0: 1, 1: 5, 2: 5, 3: 5}


def report_by_hand(pairs):
    labels = sorted({x for p in pairs for x in p})
    out = {}
    for label in labels:
        hit = sum(a == b == label for a, b in pairs)
        support, guessed = sum(a == label for a, _ in pairs), sum(b == label for _, b in pairs)
        p, r = hit / guessed if guessed else 0.0, hit / support if support else 0.0
        out[label] = (p, r, 2 * p * r / (p + r) if p + r else 0.0, support)
    return out


def test_report_matches_hand_count(spark):
    pairs = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] * 1 + [("b", "d")] * 2
    df = spark.createDataFrame(pairs, "actual string, predicted string")
    rows = metrics.classification_report(metrics.confusion(df)).collect()
    hand = report_by_hand(pairs)
    for r in rows:
        if r["kind"] == "class":
            assert (r["precision"], r["recall"], r["f1"], r["support"]) == pytest.approx(hand[r["label"]])
    lines = {r["kind"]: r for r in rows if r["kind"] != "class"}
    assert lines["accuracy"]["f1"] == pytest.approx(8 / 13)
    assert lines["macro avg"]["recall"] == pytest.approx(sum(v[1] for v in hand.values()) / 4)
    assert lines["weighted avg"]["precision"] == pytest.approx(sum(v[0] * v[3] for v in hand.values()) / 13)
    shares = metrics.normalised_confusion(metrics.confusion(df))
    for side, share in (("actual", "recall"), ("predicted", "precision")):
        sums = shares.groupBy(side).agg(F.sum(share).alias("s")).collect()
        assert all(r["s"] == pytest.approx(1.0) for r in sums)
    assert metrics.misclassified(df).first()[0] == pytest.approx(5 / 13)


def test_aspect_report_percentages(spark):
    rows = [("food", "positive")] * 3 + [("food", "conflict")] + [("price", "negative")] * 4
    report = metrics.aspect_report(
        metrics.crosstab_with_totals(spark.createDataFrame(rows, "aspect string, polarity string"))
    ).collect()
    by = {r["aspect"]: r for r in report}
    assert set(by) == {"food", "price", "Total"}
    assert by["Total"]["ranking"] == 5.0 and by["food"]["ranking"] == 2.5
    for r in report:
        assert sum(r[f"{p}_pct"] for p in metrics.POLARITIES) == pytest.approx(100)
