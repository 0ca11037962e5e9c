"""Vocabulary, label encoding, text classifiers, and scoring with an outside model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import (
    CountVectorizerModel,
    IndexToString,
    OneHotEncoder,
    StringIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from savormap.functions.vectors import decided_class, star_of_scores
from savormap.storage import cut_lineage

VOCABULARY_WORDS = 5_999  # 6,000 columns, of which the first is reserved
HIDDEN_LAYERS = (512, 256, 128)
ASPECT_EPOCHS, POLARITY_EPOCHS = 5, 6


def _exploded(tokenised: DataFrame, tokens: str, *carry: str) -> DataFrame:
    # The outer form, filtered after: the inner one would have the optimizer
    # add a size test below it that works the tokens out a second time.
    words = tokenised.select(*carry, F.explode_outer(tokens).alias("word"))
    return words.where(F.col("word").isNotNull())


def vocabulary(tokenised: DataFrame, tokens: str = "tokens", words: int = VOCABULARY_WORDS) -> DataFrame:
    """The most frequent words with their counts and 1-based rank; ties alphabetical.

    Counts combine map-side, so a word that makes up a third of the text is
    cheap; the ranking sees only the ``words`` rows that survive the limit.
    """
    counted = (
        _exploded(tokenised, tokens)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "word")
        .limit(words)
    )
    entries = counted.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "word", "n"))).alias("_all")
    )
    return entries.select(F.posexplode("_all")).select(
        F.col("col.word").alias("word"), F.col("col.n").alias("n"), (F.col("pos") + 1).alias("rank")
    )


def vectoriser(tokenised: DataFrame, tokens: str = "tokens", words: int = VOCABULARY_WORDS) -> CountVectorizerModel:
    """Multi-hot vectoriser over the vocabulary; at most ``words`` words reach the driver."""
    listed = [
        r["word"] for r in vocabulary(tokenised, tokens, words).orderBy("rank").collect()
    ]
    return CountVectorizerModel.from_vocabulary(
        listed, inputCol=tokens, outputCol="features", minTF=1.0
    ).setBinary(True)


def multi_hot(tokenised: DataFrame, table: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """Sparse multi-hot rows as (key, rank): which vocabulary words each text holds."""
    present = _exploded(tokenised.withColumn(tokens, F.array_distinct(tokens)), tokens, key)
    return present.join(table.select("word", "rank"), "word").select(key, "rank")


def one_hot(df: DataFrame, column: str, output: str = "label_vec") -> DataFrame:
    """Class index and indicator array."""
    pipeline = Pipeline(
        stages=[
            StringIndexer(inputCol=column, outputCol="label_idx", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=["label_idx"], outputCols=["_one_hot"], dropLast=False),
        ]
    )
    return (
        pipeline.fit(df)
        .transform(df)
        .withColumn(output, vector_to_array("_one_hot"))
        .drop("_one_hot")
    )


def fit_text_classifier(
    train: DataFrame,
    label: str,
    tokens: str = "tokens",
    words: int = VOCABULARY_WORDS,
    algorithm: str = "logistic",
    iterations: int = 30,
    seed: int = 42,
    classes: int | None = None,
) -> PipelineModel:
    """Multi-hot text → class. Vocabulary and label encoding come from the training rows only.

    ``logistic`` is multinomial regression; ``perceptron`` takes the three
    hidden layers and needs the number of classes.
    """
    vectors = vectoriser(train, tokens, words)
    learner = _learner(algorithm, len(vectors.vocabulary), iterations, seed, classes)
    return Pipeline(stages=[_label_coder(label), vectors, learner]).fit(train)


def _label_coder(label: str) -> StringIndexer:
    return StringIndexer(
        inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc", handleInvalid="error"
    )


def _learner(algorithm: str, width: int, iterations: int, seed: int, classes: int | None):
    if algorithm == "logistic":
        return LogisticRegression(
            featuresCol="features",
            labelCol="label_idx",
            family="multinomial",
            maxIter=iterations,
            regParam=0.01,
        )
    if algorithm == "perceptron":
        if classes is None:
            raise ValueError("the perceptron needs the number of classes")
        return MultilayerPerceptronClassifier(
            featuresCol="features",
            labelCol="label_idx",
            layers=[width, *HIDDEN_LAYERS, classes],
            maxIter=iterations,
            seed=seed,
        )
    raise ValueError(f"unknown algorithm {algorithm!r}")


def fit_text_classifiers(
    train: DataFrame,
    labels: Sequence[str],
    tokens: str = "tokens",
    words: int = VOCABULARY_WORDS,
    iterations: int = 30,
) -> dict[str, PipelineModel]:
    """A model for each label over one vocabulary and one stored pass of features.

    A row teaches the labels it has; one without a label counts for the others and the vocabulary.
    """
    vectors = vectoriser(train, tokens, words)
    ready = cut_lineage(vectors.transform(train.select(tokens, *labels)).drop(tokens))
    models = {}
    for label in labels:
        coder = _label_coder(label).fit(ready.where(F.col(label).isNotNull()))
        coded = coder.transform(ready.where(F.col(label).isNotNull()))
        learner = _learner("logistic", len(vectors.vocabulary), iterations, 0, None)
        models[label] = PipelineModel(stages=[coder, vectors, learner.fit(coded)])
    return models


def predict_labels(model: PipelineModel, df: DataFrame, output: str = "predicted") -> DataFrame:
    """Class probabilities, the decided class, and its name."""
    return _decided(model, model.stages[1].transform(df), output).drop("features")


def predict_several(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """``predicted_<label>`` of every label of ``fit_text_classifiers``; features are made once."""
    scored = next(iter(models.values())).stages[1].transform(df)
    for label, model in models.items():
        scored = _decided(model, scored, f"predicted_{label}").drop("probabilities")
    return scored.drop("features")


def _decided(model: PipelineModel, featured: DataFrame, output: str) -> DataFrame:
    scored = model.stages[2].transform(featured).withColumn("probabilities", vector_to_array("probability"))
    decided = scored.withColumn("_class", decided_class(F.col("probabilities")).cast("double"))
    named = IndexToString(inputCol="_class", outputCol=output, labels=model.stages[0].labels).transform(decided)
    return named.drop("_class", "rawPrediction", "probability", "prediction")


Scorer = Callable[[Sequence[str]], np.ndarray]


def score_texts(
    df: DataFrame, scorer: Scorer, text: str = "text", output: str = "scores"
) -> DataFrame:
    """Run a batch scorer (texts → one score row each) over Arrow batches.

    This is the one place a model from outside Spark plugs in.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = np.asarray(scorer(batch[text].fillna("").tolist()), dtype=np.float64)
            yield batch.assign(**{output: list(scores)})

    return df.mapInPandas(run, schema)


def star_ratings(df: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """Reviews with the scorer's five scores and the star rating they point to."""
    return score_texts(df, scorer, text).withColumn("stars", star_of_scores(F.col("scores")))
