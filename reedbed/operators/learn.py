"""Training and scoring of the chunk classifier with Spark ML."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def training_classes(train: DataFrame, label: str = "class_label", features: str = "features") -> DataFrame:
    """Number of classes and input width of the training data."""
    return train.agg(F.count_distinct(label).alias("num_classes"), F.max(F.size(features)).alias("input_width"))


def features_to_vector(df: DataFrame, width: int, features: str = "features", out: str = "vector") -> DataFrame:
    """Array column to ML vector; a row of another length, or null, is an error."""
    size = F.size(features)
    message = F.concat(F.lit(f"expected {width} features, found "), F.coalesce(size.cast("string"), F.lit("none")))
    checked = F.when(size == width, F.col(features)).otherwise(F.raise_error(message).cast("array<double>"))
    return df.withColumn(out, array_to_vector(checked.cast("array<double>")))


def mlp_classifier(width: int, n_classes: int, hidden: int = 128, seed: int = 42, max_iter: int = 100):
    """One hidden layer with softmax output; hidden units are sigmoid."""
    return MultilayerPerceptronClassifier(
        layers=[width, hidden, n_classes], seed=seed, maxIter=max_iter, featuresCol="vector", labelCol="_label",
        probabilityCol="_probability",
    )


MODELS: dict[str, Callable] = {"mlp": mlp_classifier}


def train_mlp(
    train: DataFrame, label: str = "class_label", features: str = "features", hidden: int = 128, seed: int = 42,
    max_iter: int = 100, n_classes: int | None = None, width: int | None = None,
) -> MultilayerPerceptronClassificationModel:
    """Fit the classifier; labels are 0..n-1. Input width and classes are taken from the data unless given."""
    if n_classes is None or width is None:
        found = training_classes(train, label, features).first()
        n_classes, width = n_classes or found["num_classes"], width or found["input_width"]
    rows = features_to_vector(train.filter(F.col(label).isNotNull()), width, features)
    return MODELS["mlp"](width, n_classes, hidden, seed, max_iter).fit(
        rows.select("vector", F.col(label).cast("double").alias("_label"))
    )


def score_chunks(
    model: MultilayerPerceptronClassificationModel, df: DataFrame, features: str = "features"
) -> DataFrame:
    """Class probabilities per chunk in ``probs``."""
    scored = model.transform(features_to_vector(df, model.numFeatures, features))
    return scored.select(*df.columns, vector_to_array("_probability").alias("probs"))
