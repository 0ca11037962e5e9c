"""Counts, errors, ranking precision, confusion tables and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from savormap.operators import metrics, ranking
from savormap.plans import views
from savormap.plans.registry import query
from savormap.plans.views import sql_over
from savormap.skew import gather_lists
from savormap.storage import cut_lineage


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("A9", "SELECT event_type AS category, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, category")
def category_counts(spark, sf):
    events = views.table(spark, sf, "events").withColumnRenamed("event_type", "category")
    return metrics.counts_by(events, "category").orderBy(F.col("n").desc(), "category")


_CROSS = """
    SELECT CASE WHEN grouping(aspect) = 1 THEN 'Total' ELSE aspect END AS aspect,
      count(*) FILTER (polarity = 'negative') AS negative, count(*) FILTER (polarity = 'neutral') AS neutral,
      count(*) FILTER (polarity = 'positive') AS positive, count(*) FILTER (polarity = 'conflict') AS conflict,
      count(*) AS "Total"
    FROM predictions GROUP BY ROLLUP (aspect)"""


@query("A10", sql_over("predictions", _CROSS))
def aspect_by_polarity(spark, sf):
    return metrics.crosstab_with_totals(views.predictions(spark, sf))


@query(
    "A11 M21",
    sql_over(
        "predictions",
        f""", x AS ({_CROSS}) SELECT aspect,
          round("Total" / (SELECT count(*) FROM predictions) * 5.0, 6) AS ranking,
          round(negative / "Total" * 100, 6) AS negative_pct, round(neutral / "Total" * 100, 6) AS neutral_pct,
          round(positive / "Total" * 100, 6) AS positive_pct, round(conflict / "Total" * 100, 6) AS conflict_pct
        FROM x""",
    ),
)
def aspect_report(spark, sf):
    table = metrics.crosstab_with_totals(views.predictions(spark, sf))
    report = metrics.aspect_report(table)
    return _rounded(report, *[c for c in report.columns if c != "aspect"])


@query(
    "A12",
    sql_over("actual_and_predicted", "SELECT actual, predicted, count(*) AS n FROM actual_and_predicted GROUP BY ALL"),
)
def quality_confusion(spark, sf):
    return metrics.confusion(views.actual_and_predicted(spark, sf))


@query(
    "A13",
    sql_over(
        "actual_and_predicted",
        """, c AS (SELECT actual, predicted, count(*) AS n FROM actual_and_predicted GROUP BY ALL)
        SELECT actual, predicted, round(n / sum(n) OVER (PARTITION BY actual), 6) AS recall,
               round(n / sum(n) OVER (PARTITION BY predicted), 6) AS precision FROM c""",
    ),
)
def quality_confusion_shares(spark, sf):
    table = metrics.confusion(views.actual_and_predicted(spark, sf))
    return _rounded(metrics.normalised_confusion(table), "recall", "precision")


@query(
    "A14",
    sql_over(
        "actual_and_predicted",
        "SELECT round(avg(CASE WHEN actual = predicted THEN 0.0 ELSE 1.0 END), 6) AS misclassified FROM actual_and_predicted",
    ),
)
def quality_misclassified(spark, sf):
    return _rounded(metrics.misclassified(views.actual_and_predicted(spark, sf)), "misclassified")


@query(
    "A15 M21",
    sql_over(
        "actual_and_predicted",
        """, k AS (SELECT DISTINCT actual AS label FROM actual_and_predicted UNION SELECT predicted FROM actual_and_predicted),
        t AS (SELECT label, count(*) FILTER (actual = label AND predicted = label) AS hit,
                count(*) FILTER (actual = label) AS support, count(*) FILTER (predicted = label) AS guessed
              FROM k, actual_and_predicted GROUP BY label),
        m AS (SELECT label, hit, support, CASE WHEN guessed > 0 THEN hit / guessed ELSE 0 END AS p,
                CASE WHEN support > 0 THEN hit / support ELSE 0 END AS r FROM t),
        f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM m)
        SELECT 'class' AS kind, label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
               CAST(support AS BIGINT) AS support FROM f
        UNION ALL SELECT 'accuracy', '', NULL, NULL, round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
        UNION ALL SELECT 'macro avg', '', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM f
        UNION ALL SELECT 'weighted avg', '', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
               round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
    ),
)
def quality_report(spark, sf):
    table = metrics.confusion(views.actual_and_predicted(spark, sf))
    return _rounded(metrics.classification_report(table), "precision", "recall", "f1")


@query(
    "A8 J5 F-7 M7",
    sql_over(
        "ratings",
        """, means AS (SELECT item_id, avg(stars) AS predicted FROM ratings GROUP BY item_id)
        SELECT round(sqrt(avg(pow(stars - predicted, 2))), 6) AS rmse FROM ratings JOIN means USING (item_id)""",
    ),
)
def item_mean_rmse(spark, sf):
    rated = views.ratings(spark, sf).select("item_id", "stars")
    means = rated.groupBy("item_id").agg(F.avg("stars").alias("predicted"))
    return _rounded(metrics.rmse(rated.join(means, "item_id"), "stars", "predicted"), "rmse")


@query(
    "A6",
    sql_over(
        "ratings",
        """SELECT user_id, count(DISTINCT item_id) AS n_items, min(item_id) AS first_item, max(item_id) AS last_item
           FROM ratings GROUP BY user_id""",
    ),
)
def items_of_each_user(spark, sf):
    pairs = cut_lineage(views.ratings(spark, sf).select("user_id", "item_id").distinct())
    lists = gather_lists(pairs, ["user_id"], ["item_id"], "items")
    return lists.groupBy("user_id").agg(
        F.sum(F.size("items")).alias("n_items"),
        F.min(F.element_at("items", 1)["item_id"]).alias("first_item"),
        F.max(F.element_at("items", -1)["item_id"]).alias("last_item"),
    )


_RANKED = """, r AS (SELECT user_id, item_id, max(stars) AS best FROM ratings GROUP BY ALL),
    ranked AS (SELECT user_id, item_id, best, row_number() OVER (PARTITION BY user_id ORDER BY best DESC, item_id) AS position
               FROM r QUALIFY position <= 50)"""
_AP = _RANKED + """, actual AS (SELECT DISTINCT user_id, item_id FROM ratings WHERE ts >= TIMESTAMP '1998-01-01'),
    size AS (SELECT user_id, count(*) AS n FROM actual GROUP BY ALL),
    hit AS (SELECT user_id, position, row_number() OVER (PARTITION BY user_id ORDER BY position) AS h
            FROM ranked JOIN actual USING (user_id, item_id) WHERE position <= 20),
    gain AS (SELECT user_id, sum(h / position) AS g FROM hit GROUP BY ALL),
    ap AS (SELECT user_id, CASE WHEN n IS NULL THEN 1.0 ELSE coalesce(g, 0) / least(n, 20) END AS average_precision
           FROM (SELECT DISTINCT user_id FROM ratings) LEFT JOIN size USING (user_id) LEFT JOIN gain USING (user_id))"""


def _ranked(rated):
    best = rated.groupBy("user_id", "item_id").agg(F.max("stars").alias("best"))
    return ranking.top_per_group(
        best, ["user_id"], [F.col("best").desc(), F.col("item_id")], ranking.USER_RECOMMENDATIONS
    )


@query(
    "W3 W7 A5",
    sql_over("ratings", f"{_RANKED} SELECT user_id, item_id, best, CAST(position AS INTEGER) AS position FROM ranked"),
)
def best_rated_of_each_user(spark, sf):
    return _ranked(views.ratings(spark, sf))


def _precision(spark, sf):
    rated = views.ratings(spark, sf).select("user_id", "item_id", "stars", "ts")
    actual = rated.where(F.col("ts") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return metrics.average_precision(_ranked(rated), actual, users=rated)


@query(
    "M8 J9 W7 A6",
    sql_over("ratings", f"{_AP} SELECT user_id, round(average_precision, 6) AS average_precision FROM ap"),
)
def average_precision_of_users(spark, sf):
    return _rounded(_precision(spark, sf), "average_precision")


@query("M9", sql_over("ratings", f"{_AP} SELECT round(avg(average_precision), 6) AS map FROM ap"))
def mean_average_precision(spark, sf):
    return _rounded(metrics.mean_average_precision(_precision(spark, sf)), "map")


@query(
    "W6",
    sql_over(
        "ratings",
        "SELECT item_id, count(*) AS n, avg(stars) AS mean FROM ratings GROUP BY item_id ORDER BY mean, n DESC, item_id LIMIT 1",
    ),
)
def worst_rated_item(spark, sf):
    means = views.ratings(spark, sf).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("stars").alias("mean")
    )
    ordered = means.withColumn("_fewest", -F.col("n"))
    return ranking.best_row(ordered, "mean", ["_fewest", "item_id"]).drop("_fewest")
