"""Named row filters for sampling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reedbed.operators.anchors import list_frequency, name_lists, same_list
from reedbed.session import materialize


def single_species_only(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_multi_species"))


def multi_species_only(df: DataFrame) -> DataFrame:
    return df.filter("is_multi_species")


def other_species_only(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("includes_target_species"))


def keep_by_frequency(df: DataFrame, wanted: Callable[[Column], Column]) -> DataFrame:
    """Rows with any species whose number of occurrences in ``df`` passes ``wanted``."""
    lists = name_lists(df)
    chosen = list_frequency(lists).filter(wanted(F.col("count")))
    names = lists.select("list_id", "names", F.explode(F.array_distinct("names")).alias("species"))
    matched = names.join(chosen, "species", "left_semi").select(F.col("list_id").alias("_list_id"), F.col("names").alias("_names"))
    matched = materialize(matched.distinct(), "matched-lists")
    return df.join(matched, same_list(matched), "left_semi")


def rare_species_only(df: DataFrame, threshold: int = 100) -> DataFrame:
    """Rows with any species that occurs fewer than ``threshold`` times in ``df``."""
    return keep_by_frequency(df, lambda n: n < threshold)


def multi_top3_targets(df: DataFrame, n_species: int) -> DataFrame:
    """Rows with exactly ``n_species`` species, a target among them, and one of the three most
    frequent labels of such rows (count descending, label ascending)."""
    pool = df.filter(
        F.col("is_multi_species")
        & (F.col("species_count") == n_species)
        & F.col("includes_target_species")
        & F.col("class_label_single").isNotNull()
    )
    counts = pool.groupBy("class_label_single").agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.col("_n").desc(), "class_label_single").limit(3).select("class_label_single")
    # Three rows by construction.
    return pool.join(F.broadcast(top), "class_label_single", "left_semi")


def multi_2_top3_targets(df: DataFrame) -> DataFrame:
    return multi_top3_targets(df, 2)


def multi_3_top3_targets(df: DataFrame) -> DataFrame:
    return multi_top3_targets(df, 3)


STRATEGIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "single-species-only": single_species_only,
    "multi-species-only": multi_species_only,
    "other-species-only": other_species_only,
    "rare-species-only": rare_species_only,
    "multi-2-species-top3-targets": multi_2_top3_targets,
    "multi-3-species-top3-targets": multi_3_top3_targets,
}


def register_strategy(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    STRATEGIES[name] = fn


def apply_strategy(df: DataFrame, strategy: str | Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Apply a named or user-given filter; None keeps all rows, an unknown name is an error."""
    if strategy is None:
        return df
    if callable(strategy):
        return df.transform(strategy)
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; known: {sorted(STRATEGIES)}")
    return df.transform(STRATEGIES[strategy])
