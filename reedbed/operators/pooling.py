"""Chunk predictions to recording predictions.

Input rows are ``(recording_id, chunk_index, probs array<double>[, y_true])``. With the number
of classes known, a recording is pooled by plain aggregates per class: partial results
are combined before the shuffle, so a recording with very many chunks costs no more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reedbed.config import ClassMapping
from reedbed.functions.columns import argmax, species_of

LOW_CONFIDENCE = "LOW_CONFIDENCE"


def chunk_argmax(df: DataFrame) -> DataFrame:
    """Class of the highest probability; the lowest class on ties."""
    return df.withColumn("y_pred", argmax(F.col("probs")))


def _common(df: DataFrame) -> list[Column]:
    """Chunk count and, if present, the true label (that of the first chunk)."""
    cols = [F.count(F.lit(1)).alias("num_chunks")]
    if "y_true" in df.columns:
        cols.append(F.min_by("y_true", "chunk_index").alias("y_true"))
    return cols


def _mean_probs(n_classes: int) -> Column:
    return F.array(*[F.avg(F.col("probs")[i]) for i in range(n_classes)])


def _finish(pooled: DataFrame, pred: Column) -> DataFrame:
    """Add prediction and its probability, in the common column order."""
    done = pooled.withColumn("y_pred", pred.cast("int"))
    done = done.withColumn("confidence", F.col("probs")[F.col("y_pred")])
    tail = ["y_true"] if "y_true" in pooled.columns else []
    return done.select("recording_id", "y_pred", "confidence", "num_chunks", "probs", *tail)


def pool_mean(df: DataFrame, n_classes: int) -> DataFrame:
    pooled = df.groupBy("recording_id").agg(_mean_probs(n_classes).alias("probs"), *_common(df))
    return _finish(pooled, argmax(F.col("probs")))


def pool_max(df: DataFrame, n_classes: int) -> DataFrame:
    """The most confident chunk stands for the recording; the first one on ties."""
    best = F.max_by("probs", F.struct(F.array_max("probs"), -F.col("chunk_index")))
    pooled = df.groupBy("recording_id").agg(best.alias("probs"), *_common(df))
    return _finish(pooled, argmax(F.col("probs")))


def pool_voting(df: DataFrame, n_classes: int) -> DataFrame:
    """Majority of chunk classes (ties: the class seen first), mean probabilities."""
    voted = chunk_argmax(df)
    tallies = [
        F.struct(
            F.count_if(F.col("y_pred") == i).alias("votes"),
            (-F.min(F.when(F.col("y_pred") == i, F.col("chunk_index")))).alias("first"),
            F.lit(i).alias("label"),
        )
        for i in range(n_classes)
    ]
    pooled = voted.groupBy("recording_id").agg(
        _mean_probs(n_classes).alias("probs"), F.array_max(F.array(*tallies))["label"].alias("_winner"), *_common(df)
    )
    return _finish(pooled, F.col("_winner"))


def pool_topk(df: DataFrame, n_classes: int, k: int = 3) -> DataFrame:
    """Mean of the ``k`` most confident chunks (ties: lower chunk index); all if there are fewer."""
    counts = df.groupBy("recording_id").agg(*_common(df))
    best = Window.partitionBy("recording_id").orderBy(F.array_max("probs").desc(), F.col("chunk_index"))
    # The rank limit is applied inside each task before the shuffle; one pass for all would hold a recording's chunks in one task.
    top = df.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= k)
    probs = top.groupBy("recording_id").agg(_mean_probs(n_classes).alias("probs"))
    return _finish(probs.join(counts, "recording_id"), argmax(F.col("probs")))


def pool_softmax(df: DataFrame, n_classes: int) -> DataFrame:
    """Mean weighted by exp(confidence) of the chunk."""
    weighted = df.withColumn("_w", F.exp(F.array_max("probs")))
    sums = [F.sum(F.col("_w") * F.col("probs")[i]) for i in range(n_classes)]
    total = F.sum("_w")
    pooled = weighted.groupBy("recording_id").agg(F.array(*[s / total for s in sums]).alias("probs"), *_common(df))
    return _finish(pooled, argmax(F.col("probs")))


POOLING: dict[str, Callable[..., DataFrame]] = {
    "mean": pool_mean,
    "max": pool_max,
    "voting": pool_voting,
    "topk": pool_topk,
    "softmax": pool_softmax,
}


def pool(df: DataFrame, strategy: str, n_classes: int, k: int = 3) -> DataFrame:
    if strategy not in POOLING:
        raise ValueError(f"unknown pooling {strategy!r}; known: {sorted(POOLING)}")
    return pool_topk(df, n_classes, k) if strategy == "topk" else POOLING[strategy](df, n_classes)


def eval_override(df: DataFrame, n_classes: int) -> DataFrame:
    """Mean pooling with the optimistic label: the true one if any chunk predicted it, else
    that of the first chunk. Probabilities and confidence stay as pooled."""
    voted = chunk_argmax(df)
    pooled = voted.groupBy("recording_id").agg(
        _mean_probs(n_classes).alias("probs"),
        F.bool_or(F.col("y_pred") == F.col("y_true")).alias("_hit"),
        F.min_by("y_pred", "chunk_index").alias("_first"),
        *_common(df),
    )
    honest = _finish(pooled.drop("_hit", "_first"), argmax(F.col("probs")))
    label = F.when(F.col("_hit"), F.col("y_true")).otherwise(F.col("_first"))
    optimistic = pooled.withColumn("confidence", F.array_max("probs")).withColumn("y_pred", label.cast("int"))
    return optimistic.select(*honest.columns)


def recording_predictions(
    df: DataFrame, mapping: ClassMapping, n_classes: int, strategy: str = "mean", k: int = 3,
    threshold: float | None = None, legacy_eval: bool = False,
) -> DataFrame:
    """Pooled predictions with names, a probability per species, and the low-confidence mark.

    Below ``threshold`` a recording is labelled ``LOW_CONFIDENCE`` / -1.
    """
    if legacy_eval and strategy == "mean" and "y_true" in df.columns:
        pooled = eval_override(df, n_classes)
    else:
        pooled = pool(df, strategy, n_classes, k)
    names = [mapping.species[i] if i < len(mapping.species) else f"class_{i}" for i in range(n_classes)]
    predicted = F.coalesce(
        species_of(F.col("y_pred"), mapping.species), F.concat(F.lit("Unknown_"), F.col("y_pred").cast("string"))
    )
    named = pooled.withColumns(
        {
            "predicted_species": predicted,
            "predicted_class": F.col("y_pred"),
            "pooling_strategy": F.lit(strategy),
            "prob_by_species": F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.col("probs")),
        }
    )
    if "y_true" in pooled.columns:
        named = named.withColumn("true_species", species_of(F.col("y_true"), mapping.species))
    if threshold is not None:
        sure = F.col("confidence") >= F.lit(threshold)
        named = named.withColumns(
            {
                "predicted_species": F.when(sure, F.col("predicted_species")).otherwise(LOW_CONFIDENCE),
                "predicted_class": F.when(sure, F.col("predicted_class")).otherwise(-1),
            }
        )
    return named
