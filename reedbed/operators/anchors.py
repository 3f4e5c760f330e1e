"""Anchors: which species stands for a recording with several of them.

Each adds ``anchor_species`` to rows that carry the sorted ``species_names``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reedbed.functions.columns import only
from reedbed.session import materialize


def species_frequency(df: DataFrame, names: str = "species_names") -> DataFrame:
    """Occurrences per species, repeats counted."""
    exploded = df.select(F.explode(names).alias("species")).filter(F.col("species").isNotNull())
    return exploded.groupBy("species").agg(F.count(F.lit(1)).alias("count"))


def name_lists(df: DataFrame) -> DataFrame:
    """The dictionary of species lists: each different list, ``names``, with its ``list_id`` and the number of its rows.

    It is written once. What depends on the list alone is found on it and joined back by the id, so rows need no
    key and the source is planned once more only.
    """
    lists = df.groupBy(F.col("species_names").alias("names")).agg(F.count(F.lit(1)).alias("rows"))
    return materialize(lists.withColumn("list_id", list_id("names")), "species-lists")


def list_id(names: str) -> Column:
    """A digest of the list; as two lists may share one, joins by it compare the lists, too."""
    return F.xxhash64(F.array_join(names, "\x1f", "\x1e"))


def same_list(lists: DataFrame) -> Column:
    """Whether a row has the list of a row of ``lists`` (``_list_id``, ``_names``)."""
    return (list_id("species_names") == lists["_list_id"]) & (F.col("species_names") == lists["_names"])


def list_frequency(lists: DataFrame) -> DataFrame:
    """Occurrences per species over the rows behind ``name_lists``, repeats counted."""
    spread = lists.select("rows", F.explode("names").alias("species")).filter(F.col("species").isNotNull())
    return spread.groupBy("species").agg(F.sum("rows").alias("count"))


def anchor_first(df: DataFrame, targets: Sequence[str] = ()) -> DataFrame:
    return df.withColumn("anchor_species", F.try_element_at("species_names", F.lit(1)))


def anchor_first_target(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    return df.withColumn("anchor_species", F.try_element_at(only(F.col("species_names"), targets), F.lit(1)))


def _most_frequent(df: DataFrame, candidates: Callable[[Column], Column]) -> DataFrame:
    """Most frequent candidate; ties go to the first in the list. One way for any number of species, ids play no part."""
    lists = name_lists(df)
    spread = lists.select("list_id", "names", F.posexplode(candidates(F.col("names"))).alias("p", "species"))
    best = (
        spread.join(list_frequency(lists), "species")
        .groupBy(F.col("list_id").alias("_list_id"), F.col("names").alias("_names"))
        .agg(F.max_by("species", F.struct("count", -F.col("p"))).alias("anchor_species"))
    )
    best = materialize(best, "list-anchors")
    return df.drop("anchor_species").join(best, same_list(best), "left").drop("_list_id", "_names")


def anchor_most_frequent(df: DataFrame, targets: Sequence[str] = ()) -> DataFrame:
    """Most frequent species over all rows of ``df``."""
    return _most_frequent(df, lambda names: names)


def anchor_most_frequent_target(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """The same among target species."""
    return _most_frequent(df, lambda names: only(names, targets))


ANCHORS: dict[str, Callable[[DataFrame, Sequence[str]], DataFrame]] = {
    "first": anchor_first,
    "first-target": anchor_first_target,
    "most-frequent": anchor_most_frequent,
    "most-frequent-target": anchor_most_frequent_target,
}


def python_anchor(choose: Callable[[list[str], set[str]], str | None]) -> Callable[[DataFrame, Sequence[str]], DataFrame]:
    """A user rule ``(species list, targets) -> species`` as an anchor, run in Arrow batches."""

    def add(df: DataFrame, targets: Sequence[str]) -> DataFrame:
        wanted = set(targets)

        @F.pandas_udf("string")
        def pick(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield batch.map(lambda names: choose(list(names), wanted) if names is not None else None)

        return df.withColumn("anchor_species", pick("species_names"))

    return add
