"""Semi and anti joins between recordings, split ids and inventories.

Id lists grow with the data, so no side carries a broadcast hint: statistics and
adaptive execution decide, and split a hot id of the big side if there is one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def modelling_subset(cleaned: DataFrame, ids: DataFrame, subset: str | None = None) -> DataFrame:
    """Rows used for modelling, or for one of its splits."""
    wanted = ids if subset is None else ids.filter(F.col("split") == subset)
    return cleaned.join(wanted.select("id"), "id", "left_semi")


def holdout_pool(cleaned: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows never used for modelling."""
    return cleaned.join(ids.select("id"), "id", "left_anti")


def reconcile_audio(df: DataFrame, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(available, missing)`` by the audio inventory."""
    return df.join(inventory.select("id"), "id", "left_semi"), df.join(inventory.select("id"), "id", "left_anti")


def drop_missing_audio(df: DataFrame, missing: DataFrame) -> DataFrame:
    return df.join(missing.select("id"), "id", "left_anti")


def unused_pool(pool: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows of the pool that are not sampled yet."""
    return pool.join(taken.select("id"), "id", "left_anti")


def download_summary(
    required: DataFrame, inventory: DataFrame, failed: DataFrame, can_download: bool = True
) -> DataFrame:
    """Counters of a fetch run in one row.

    ``failed`` are ids that were tried and did not arrive. Where nothing can be
    fetched, every file absent from the inventory stays missing.
    """
    have = inventory.select("id").distinct().withColumn("_have", F.lit(True))
    lost = failed.select("id").distinct().withColumn("_failed", F.lit(True))
    rows = required.select("id").join(have, "id", "left").join(lost, "id", "left")
    absent = F.col("_have").isNull()
    failed_row = absent & F.col("_failed").isNotNull() if can_download else F.lit(False)
    gone = failed_row if can_download else absent
    counts = rows.agg(
        F.count(F.lit(1)).alias("required_count"),
        F.count_if(~absent).alias("available_count"),
        F.count_if(absent).alias("missing_from_directory_count"),
        F.count_if(absent & ~failed_row if can_download else F.lit(False)).alias("downloaded_count"),
        F.count_if(failed_row).alias("failed_to_download_count"),
        F.count_if(gone).alias("missing_after_download_count"),
    )
    ready = F.col("required_count") - F.col("missing_after_download_count")
    return counts.withColumn("ready_for_use_count", ready).withColumn(
        "has_complete_data", F.col("required_count") == F.col("ready_for_use_count")
    )
