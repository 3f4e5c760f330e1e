"""Feature tables kept in versions: a version is a list of partition folders, and a new one shares what did not change.

``<root>/data`` holds the folders, each written once and never changed; ``<root>/versions`` holds the lists, one small
file a version. The file appears in one step when its job ends, so readers see the version before or the one
behind, and a run that fails leaves folders that no version names. One job at a time may write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reedbed.sources.embeddings import retain_features
from reedbed.sources.tables import read_or_empty

VERSIONS = "version int, folder string, layout string"
RUN = "written_by"  # first level of the folders below data: the run that wrote them


def _folder() -> Column:
    return F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")


def _folders(df: DataFrame) -> list[str]:
    """The partition folders that hold rows of ``df``: as many as a table has partitions at most, whatever its rows."""
    return sorted(unquote(r[0]) for r in df.select(_folder()).distinct().collect())


def _read(spark: SparkSession, root: str, folders: Sequence[str], layout: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).option("basePath", f"{root}/data").parquet(*folders).select(*[F.col(f"`{c}`") for c in layout.names])


def _write(rows: DataFrame, root: str, partition_by: Sequence[str]) -> list[str]:
    """Rows in folders of their own; the folders."""
    path = f"{root}/data/{RUN}={uuid.uuid4().hex}"
    rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    return _folders(rows.sparkSession.read.schema(rows.schema).parquet(path))


def _publish(spark: SparkSession, root: str, version: int, folders: Sequence[str], layout: T.StructType) -> None:
    entries = [(version, f, layout.json()) for f in folders or [None]]
    spark.createDataFrame(entries, VERSIONS).coalesce(1).write.mode("append").parquet(f"{root}/versions")


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The number of the newest version; None before the first."""
    return read_or_empty(spark, f"{root}/versions", VERSIONS).agg(F.max("version")).first()[0]


def version_folders(spark: SparkSession, root: str, version: int) -> tuple[list[str], T.StructType]:
    """The folders of a version, none if it has no rows, and the layout of its rows."""
    named = read_or_empty(spark, f"{root}/versions", VERSIONS).filter(F.col("version") == version)
    found = named.select("folder", "layout").collect()
    if not found:
        raise ValueError(f"no version {version} in {root}")
    return sorted(r["folder"] for r in found if r["folder"] is not None), T.StructType.fromJson(json.loads(found[0]["layout"]))


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the newest."""
    return _read(spark, root, *version_folders(spark, root, latest_version(spark, root) if version is None else version))


def create_versions(rows: DataFrame, root: str, partition_by: Sequence[str]) -> int:
    """Store ``rows`` as the first version."""
    if latest_version(rows.sparkSession, root) is not None:
        raise ValueError(f"{root} has versions already")
    _publish(rows.sparkSession, root, 0, _write(rows, root, partition_by), rows.schema)
    return 0


def rewrite_retained(
    spark: SparkSession, root: str, partition_by: Sequence[str], keep_ids: DataFrame,
    keep_formats: list[str] | None = None, allow_empty_keep: bool = False, id_col: str = "id", format_col: str = "format",
) -> tuple[int, DataFrame]:
    """Keep the wanted ids, and formats if given, in a new version; ``(its number, removed rows)``.

    Only the partitions that lose rows are read again and written; the others' folders are listed as they are. If nothing
    is lost there is no new version. The removed rows are read from the version before, which stays.
    """
    version = latest_version(spark, root)
    folders, layout = version_folders(spark, root, version)
    options = (keep_ids, keep_formats, allow_empty_keep, id_col, format_col)
    marked = _read(spark, root, folders, layout).withColumn("_folder", _folder() if folders else F.lit(""))
    _, removed = retain_features(marked, *options)
    losing = {unquote(r[0]) for r in removed.select("_folder").distinct().collect()}
    if losing:
        kept, _ = retain_features(_read(spark, root, sorted(losing), layout), *options)
        fresh = _write(kept, root, partition_by)
        version += 1
        _publish(spark, root, version, [f for f in folders if f not in losing] + fresh, layout)
    return version, removed.drop("_folder")
