"""Split ids, evaluation artifacts, audio inventories, scoring tables, time-ranged features."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reedbed.session import materialize
from reedbed.sources.tables import read_or_empty, read_table, write_table


def write_split_ids(ids: DataFrame, path: str) -> None:
    """Persist ``(id, split)``; one folder per split, so one split is read alone."""
    ids.select("id", "split").write.mode("overwrite").partitionBy("split").parquet(path)


def read_split_ids(spark: SparkSession, path: str, subset: str | None = None) -> DataFrame:
    ids = spark.read.parquet(path).select("id", F.col("split").cast("string").alias("split"))
    return ids if subset is None else ids.filter(F.col("split") == subset)


def split_ids_roundtrip(ids: DataFrame, path: str, subset: str | None = None) -> DataFrame:
    write_split_ids(ids, path)
    return read_split_ids(ids.sparkSession, path, subset)


def read_eval_artifacts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Predictions, class mapping and test ids of an evaluation run."""
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("predictions", "class_mapping", "test_ids")}


def ids_from_paths(paths: DataFrame, extension: str, path_col: str = "path") -> DataFrame:
    """Recording ids named by audio file paths; only all-digit stems count."""
    stem = F.regexp_extract(F.col(path_col), r"([^/]+)\." + extension.lstrip(".") + "$", 1)
    return paths.select(stem.alias("_stem")).filter(F.col("_stem").rlike(r"^\d+$")).select(
        F.col("_stem").cast("bigint").alias("id")
    )


def _list_folders(root: str, extension: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists each folder of the batches: its files of the extension and its sub-folders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = fs.FileSystem.from_uri(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                # A sub-folder may be gone since it was listed; the top one must be there.
                here = fs.FileSelector(top if folder is None else folder, allow_not_found=folder is not None)
                paths, is_folder = [], []
                for entry in system.get_file_info(here):
                    down = entry.type == fs.FileType.Directory and not entry.base_name.startswith((".", "_"))
                    if down or (entry.type == fs.FileType.File and entry.base_name.endswith(extension)):
                        paths.append(entry.path)
                        is_folder.append(down)
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(is_folder, pa.bool_())], ["path", "is_folder"])

    return run


def list_files(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """Paths of the files below ``folder`` with an extension, listed by tasks.

    Level by level, the sub-folders found are spread over tasks and listed there; a level is written before the next, and the
    driver holds no file names. One folder is listed by one task. Folders named ``.x`` or ``_x`` are left out.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = _list_folders(folder, f".{extension.lstrip('.')}")
    # The top folder is named by null: below it, paths are those of its file system, without scheme and escapes.
    level, found = spark.createDataFrame([(None,)], "path string"), []
    while True:
        listed = materialize(level.mapInArrow(run, "path string, is_folder boolean"), "listing")
        found.append(listed.filter(~F.col("is_folder")).select("path"))
        below = listed.filter("is_folder").select("path")
        if below.isEmpty():
            return reduce(DataFrame.unionAll, found)
        level = below.repartition(tasks)


def scan_audio_inventory(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """Ids of the audio files below a folder; file contents are not read."""
    return ids_from_paths(list_files(spark, folder, extension), extension)


def inventory_ids(spark: SparkSession, manifest: str) -> DataFrame:
    """Ids that are there by the manifest: those whose last change is an addition."""
    changes = read_or_empty(spark, manifest, "id bigint, change string, scan int")
    last = changes.groupBy("id").agg(F.max_by("change", "scan").alias("change"))
    return last.filter("change = 'added'").select("id")


def update_inventory(present: DataFrame, manifest: str) -> DataFrame:
    """Note in the manifest which ids came or went since its last scan; ``(id, change)`` of this scan.

    A scan adds its changes only, as one job, so one that fails notes nothing. Without changes nothing is written.
    """
    spark = present.sparkSession
    known = inventory_ids(spark, manifest).withColumn("_known", F.lit(True))
    now = present.select("id").distinct().withColumn("_now", F.lit(True))
    change = F.when(F.col("_known").isNull(), "added").when(F.col("_now").isNull(), "gone")
    changes = materialize(now.join(known, "id", "full_outer").select("id", change.alias("change")).filter("change IS NOT NULL"), "changes")
    if not changes.isEmpty():
        last = read_or_empty(spark, manifest, "scan int").agg(F.max("scan")).first()[0]
        numbered = changes.withColumn("scan", F.lit(0 if last is None else last + 1))
        write_table(numbered, manifest, "append", ["scan"])
    return changes


def batch_score_table(
    spark: SparkSession, in_table: str, out_table: str, scorer: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Read a table, score it, write the predictions, return them as stored."""
    write_table(scorer(read_table(spark, in_table)), out_table, "overwrite")
    return read_table(spark, out_table)


def feature_table_range(
    df: DataFrame, ts_col: str, start: str | None, end: str | None, keys: Sequence[str], tie_col: str
) -> DataFrame:
    """Latest row per key in ``[start, end)``; a missing bound is open.

    Equal times go to the largest ``tie_col``. The rank limit lets each task drop all
    but its own best row per key before the shuffle, so a hot key stays cheap.
    """
    ranged = df
    if start:
        ranged = ranged.filter(F.col(ts_col) >= F.lit(start).cast("timestamp_ntz"))
    if end:
        ranged = ranged.filter(F.col(ts_col) < F.lit(end).cast("timestamp_ntz"))
    latest = Window.partitionBy(*keys).orderBy(F.col(ts_col).desc(), F.col(tie_col).desc())
    return ranged.withColumn("_rn", F.row_number().over(latest)).filter("_rn = 1").drop("_rn")
