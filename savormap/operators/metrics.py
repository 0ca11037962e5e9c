"""Evaluation: errors, ranking precision, confusion tables and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

MAP_DEPTH = 20
# Polarity classes, in the report's order.
POLARITIES = ("negative", "neutral", "positive", "conflict")
TOTAL = "Total"


def summary_statistics(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum in one pass."""
    value = F.col(column)
    return df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def rmse(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Root of the mean squared error; every row counts once."""
    error = F.col(actual) - F.col(predicted)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def average_precision(
    predicted: DataFrame,
    actual: DataFrame,
    k: int = MAP_DEPTH,
    user: str = "user_id",
    item: str = "item_id",
    users: DataFrame | None = None,
) -> DataFrame:
    """Average precision at ``k`` per user, from (user, item, 1-based position) and (user, item).

    Sum of hits so far over position at each hit, divided by min(actual, k); a
    user without actual items scores 1. ``users`` says who is measured, by
    default everyone with actual items.
    """
    truth = actual.select(user, item).distinct()
    sizes = truth.groupBy(user).agg(F.count(F.lit(1)).alias("_actual"))
    # At most k rows per user survive the filter, which bounds the window.
    in_order = W.partitionBy(user).orderBy("position")
    gains = (
        predicted.where(F.col("position") <= k)
        .join(truth, [user, item], "left_semi")
        .withColumn("_hit", F.row_number().over(in_order))
        .groupBy(user)
        .agg(F.sum(F.col("_hit") / F.col("position")).alias("_gain"))
    )
    measured = users.select(user).distinct().join(sizes, user, "left") if users is not None else sizes
    return measured.join(gains, user, "left").select(
        user,
        F.when(F.col("_actual").isNull(), F.lit(1.0))
        .otherwise(F.coalesce("_gain", F.lit(0.0)) / F.least(F.col("_actual"), F.lit(k)))
        .alias("average_precision"),
    )


def mean_average_precision(per_user: DataFrame) -> DataFrame:
    """Mean over users."""
    return per_user.agg(F.avg("average_precision").alias("map"))


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination, combined map-side."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def crosstab_with_totals(
    predictions: DataFrame,
    rows: str = "aspect",
    columns: str = "polarity",
    values: Sequence[str] = POLARITIES,
) -> DataFrame:
    """Counts of rows × columns with a Total row and column.

    The data is counted once per pair; the totals come from that small table.
    Rows of a column value that isn't listed, or null, are in no count.
    """
    return (
        counts_by(predictions.where(F.col(columns).isin(*values)), rows, columns)
        .rollup(rows)
        .agg(
            *[F.coalesce(F.sum(F.when(F.col(columns) == v, F.col("n"))), F.lit(0)).alias(v) for v in values],
            F.sum("n").alias(TOTAL),
            F.grouping(rows).alias("_all"),
        )
        .withColumn(rows, F.when(F.col("_all") == 1, F.lit(TOTAL)).otherwise(F.col(rows)))
        .drop("_all")
    )


def aspect_report(
    crosstab: DataFrame, rows: str = "aspect", values: Sequence[str] = POLARITIES
) -> DataFrame:
    """Ranking (share of all predictions × 5) and polarity percentages per aspect."""
    everything = F.max(TOTAL).over(W.partitionBy())  # a few rows: the classes and their total
    share = lambda name: F.col(name) / F.col(TOTAL) * 100
    return crosstab.select(
        rows,
        (F.col(TOTAL) / everything * 5.0).alias("ranking"),
        *[share(v).alias(f"{v}_pct") for v in values],
    )


def confusion(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Counts per (actual, predicted)."""
    return counts_by(
        df.select(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")),
        "actual",
        "predicted",
    )


def normalised_confusion(table: DataFrame) -> DataFrame:
    """Each cell's share of its actual class (recall) and of its predicted class (precision)."""
    share = lambda by: F.col("n") / F.sum("n").over(W.partitionBy(by))
    return table.select(
        "actual",
        "predicted",
        share("actual").alias("recall"),
        share("predicted").alias("precision"),
    )


def misclassified(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Share of rows predicted wrongly."""
    wrong = F.when(F.col(actual) == F.col(predicted), 0.0).otherwise(1.0)
    return df.agg(F.avg(wrong).alias("misclassified"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def classification_report(table: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages.

    Works on the confusion counts, so its size is classes², not rows. Rows are
    labelled by ``kind`` (class, accuracy, macro avg, weighted avg).
    """
    cell = lambda label, support, guessed: F.struct(
        label.cast("string").alias("label"), support.alias("support"), guessed.alias("guessed")
    )
    none = F.lit(0).cast("long")
    sides = table.select(
        F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(none).alias("_right"),
        F.explode(
            F.array(
                cell(F.col("actual"), F.col("n"), none),
                cell(F.col("predicted"), none, F.col("n")),
            )
        ).alias("_side"),
    )
    right = F.sum(F.when(F.col("_side.support") > 0, F.col("_right")).otherwise(none))
    classes = (
        sides.groupBy(F.col("_side.label").alias("label"))
        .agg(
            right.alias("_right"),
            F.sum("_side.support").alias("support"),
            F.sum("_side.guessed").alias("_guessed"),
        )
        .withColumn("precision", _ratio(F.col("_right"), F.col("_guessed")))
        .withColumn("recall", _ratio(F.col("_right"), F.col("support")))
        .withColumn(
            "f1",
            _ratio(
                2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
            ),
        )
    )
    measures = ("precision", "recall", "f1")
    # A class that was only predicted has no support of its own.
    weighted = lambda m: F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support"))
    rolled = classes.rollup("label").agg(
        F.grouping("label").alias("_all"),
        F.sum("support").alias("support"),
        F.try_divide(F.sum("_right"), F.sum("support")).alias("_accuracy"),
        *[F.avg(m).alias(f"_macro_{m}") for m in measures],
        *[weighted(m).alias(f"_weighted_{m}") for m in measures],
    )
    line = lambda kind, label, p, r, f: F.struct(
        F.lit(kind).alias("kind"), label.alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1")
    )
    blank, null = F.lit(""), F.lit(None).cast("double")
    of = lambda prefix: [F.col(f"_{prefix}_{m}") for m in measures]
    lines = F.when(
        F.col("_all") == 0, F.array(line("class", F.col("label"), *of("macro")))
    ).otherwise(
        F.array(
            line("accuracy", blank, null, null, F.col("_accuracy")),
            line("macro avg", blank, *of("macro")),
            line("weighted avg", blank, *of("weighted")),
        )
    )
    return rolled.select(F.explode(lines).alias("_line"), "support").select("_line.*", "support")
