"""Cleaning filters and the filter funnel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reedbed.config import CleaningCriteria
from reedbed.functions.columns import percent

# Column registry of the cleaned recordings, in output order.
CLEANED_COLUMNS = [
    "id", "state", "call_audio", "year", "month", "hour", "is_multi_species", "species_count",
    "includes_target_species", "target_species_count", "target_species_ratio", "species_type",
    "species_names", "species_ids", "class_labels", "class_label_single", "species_name_single",
    "class_name_single", "class_label_vector",
]


def _published() -> Column:
    return F.col("validated_status") == "published"


def _has_audio() -> Column:
    return F.col("call_audio").isNotNull() & (F.trim("call_audio") != "")


def _labelled() -> Column:
    return F.size("validated_frog_names") > 0


def _is_not(flag: str, value: bool) -> Column:
    """Missing flags pass."""
    return ~F.col(flag).eqNullSafe(value)


def filter_published(df: DataFrame) -> DataFrame:
    return df.filter(_published())


def filter_has_audio(df: DataFrame) -> DataFrame:
    return df.filter(_has_audio())


def filter_labelled(df: DataFrame) -> DataFrame:
    return df.filter(_labelled())


def filter_not_duplicate(df: DataFrame) -> DataFrame:
    return df.filter(_is_not("is_duplicate", True))


def filter_appropriate(df: DataFrame) -> DataFrame:
    return df.filter(_is_not("inappropriate_content", True))


def filter_no_people(df: DataFrame) -> DataFrame:
    return df.filter(_is_not("has_people_activity", True))


def filter_quality(df: DataFrame) -> DataFrame:
    return df.filter(_is_not("quality_call", False))


def cleaning_steps(criteria: CleaningCriteria, order: str = "selector") -> list[tuple[str, Column]]:
    """Named predicates in the order of the modelling run or of the dashboard."""
    base = [("published", _published()), ("has_audio", _has_audio()), ("labelled", _labelled())]
    if order == "dashboard":
        base = [base[2], base[0], base[1]]
    elif order != "selector":
        raise ValueError(f"unknown step order: {order}")
    switched = [
        (not criteria.allow_duplicates, "not_duplicate", _is_not("is_duplicate", True)),
        (not criteria.allow_inappropriate, "appropriate", _is_not("inappropriate_content", True)),
        (not criteria.allow_people_activity, "no_people", _is_not("has_people_activity", True)),
        (criteria.avoid_poor_quality, "good_quality", _is_not("quality_call", False)),
    ]
    return base + [(name, cond) for wanted, name, cond in switched if wanted]


def keep_condition(criteria: CleaningCriteria = CleaningCriteria()) -> Column:
    """All cleaning predicates at once; false, never null, for a dropped row."""
    conditions = [cond for _, cond in cleaning_steps(criteria)]
    return F.coalesce(reduce(lambda a, b: a & b, conditions), F.lit(False))


def clean_recordings(df: DataFrame, criteria: CleaningCriteria = CleaningCriteria()) -> DataFrame:
    return reduce(lambda d, step: d.filter(step[1]), cleaning_steps(criteria), df)


def filter_funnel(
    df: DataFrame, criteria: CleaningCriteria = CleaningCriteria(), order: str = "selector"
) -> DataFrame:
    """Rows left after each step, ``(step_number, step, count, percentage)``, in one pass."""
    steps = [("raw", F.lit(True))]
    for name, cond in cleaning_steps(criteria, order):
        steps.append((name, steps[-1][1] & F.coalesce(cond, F.lit(False))))
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in steps])
    rows = F.array(
        *[F.struct(F.lit(i + 1).alias("n"), F.lit(name).alias("s"), F.col(name).alias("c"))
          for i, (name, _) in enumerate(steps)]
    )
    return counts.select(F.col("raw").alias("_raw"), F.inline(rows).alias("step_number", "step", "count")).select(
        "step_number", "step", "count", percent(F.col("count"), F.col("_raw"), 0).alias("percentage")
    )


def project_cleaned(df: DataFrame) -> DataFrame:
    """Only the registered columns."""
    return df.select(*CLEANED_COLUMNS)
