"""The embedding store: coverage, append, read, incremental features, retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reedbed.config import EmbeddingSettings
from reedbed.session import materialize
from reedbed.sources.tables import layout_of, read_or_empty, write_table

STORE_SCHEMA = (
    "audio_id string, chunk_index int, embedding array<float>, embedding_strategy string, "
    "species_name string, embedding_from string, window_sec float, overlap_window_sec float"
)
STORE_COLUMNS = [part.split()[0] for part in STORE_SCHEMA.split(", ")]
# A recording's rows are all in one bucket, so a batch looks for what is stored in its own buckets only.
BUCKETS = 64
BUCKET = "id_bucket"
# Few values each, so a fixed setting or bucket prunes whole folders; ids would make one folder per recording.
PARTITIONS = ["embedding_from", "embedding_strategy", BUCKET]


def bucket_of(id_col: str | Column) -> Column:
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.xxhash64(col.cast("string")), F.lit(BUCKETS)).cast("int")


def setting_columns(settings: EmbeddingSettings) -> dict[str, Column]:
    return {
        "embedding_strategy": F.lit(settings.strategy),
        "embedding_from": F.lit(settings.source),
        "window_sec": F.lit(settings.window_sec).cast("float"),
        "overlap_window_sec": F.lit(settings.overlap_sec).cast("float"),
    }


def at_settings(store: DataFrame, settings: EmbeddingSettings) -> DataFrame:
    """Rows of the store made with these settings."""
    wanted = [F.col(c) == v for c, v in setting_columns(settings).items()]
    return store.filter(reduce(lambda a, b: a & b, wanted))


def to_store_rows(features: DataFrame, settings: EmbeddingSettings) -> DataFrame:
    """Feature rows ``(id, chunk_index, features, species_name)`` in the store's layout."""
    return features.select(
        F.col("id").cast("string").alias("audio_id"),
        F.col("chunk_index").cast("int").alias("chunk_index"),
        F.col("features").cast("array<float>").alias("embedding"),
        F.col("species_name").cast("string").alias("species_name"),
    ).withColumns(setting_columns(settings)).select(*STORE_COLUMNS)


def embedding_coverage(
    df: DataFrame, store: DataFrame, settings: EmbeddingSettings, id_col: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Rows whose recording has stored vectors at these settings, and the rows still to do.

    Coverage is by recording, not by chunk. Only the buckets of the ids of ``df`` are read, and of the
    ids stored there those of ``df`` are made distinct and written once: a recording with very many stored
    chunks is one row there, both results share the list, and its known size lets a short list be
    broadcast, so the wide rows of ``df`` are not shuffled for it.
    """
    wanted = materialize(df.select(F.col(id_col).cast("string").alias("audio_id")).distinct(), "wanted-ids")
    near = in_buckets_of(at_settings(store, settings), wanted).select("audio_id")
    stored = materialize(near.join(wanted, "audio_id", "left_semi").distinct().withColumnRenamed("audio_id", "_stored"), "stored-ids")
    match = F.col(id_col).cast("string") == F.col("_stored")
    return df.join(stored, match, "left_semi"), df.join(stored, match, "left_anti")


def read_store(spark: SparkSession, table: str) -> DataFrame:
    """The stored table, or an empty frame of its layout before the first write."""
    return read_buckets(spark, table).select(*STORE_COLUMNS)


def read_buckets(spark: SparkSession, table: str) -> DataFrame:
    """The stored table with the bucket of each row; it is null in tables written without buckets."""
    stored = read_or_empty(spark, table, STORE_SCHEMA)
    return stored if BUCKET in stored.columns else stored.withColumn(BUCKET, F.lit(None).cast("int"))


def in_buckets_of(store: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the store that may belong to one of the ``audio_id`` of ``ids``: other buckets' folders are not listed or read.

    The numbers of the buckets, ``BUCKETS`` at most, are fetched first. Rows without a bucket may belong to any id.
    """
    if BUCKET not in store.columns:
        return store
    numbers = [r[0] for r in ids.select(bucket_of("audio_id")).distinct().collect()]
    return store.filter(F.col(BUCKET).isin(numbers) | F.col(BUCKET).isNull())


def append_rows(rows: DataFrame, table: str) -> None:
    """Append rows of the store's layout. Rows of a bucket go to one file, or to several if there are very many.

    A table that was written without buckets stays so.
    """
    known = layout_of(rows.sparkSession, table)
    if known is not None and BUCKET not in known:
        write_table(rows, table, "append", [c for c in PARTITIONS if c != BUCKET])
    else:
        write_table(rows.withColumn(BUCKET, bucket_of("audio_id")).hint("rebalance", BUCKET), table, "append", PARTITIONS)


def write_embeddings(features: DataFrame, table: str, settings: EmbeddingSettings) -> None:
    """Append the vectors of recordings that are not stored yet at these settings."""
    _, to_do = embedding_coverage(features, read_buckets(features.sparkSession, table), settings)
    append_rows(to_store_rows(to_do, settings), table)


def append_new_chunks(
    batch: DataFrame, table: str, settings: EmbeddingSettings, batch_id: int | None = None, stream: str = "append"
) -> bool:
    """Append the chunks of a micro-batch that the store lacks at these settings; whether it was looked at.

    A batch with a ``batch_id`` is noted in a log beside the table once its rows are there, one entry a batch, and a
    batch that is noted is not looked at again. A batch that failed before its note adds what is missing:
    known ``(audio_id, chunk_index)`` are dropped, and so are repeats inside the batch. Only the buckets
    of the batch's ids are read.
    """
    spark, log = batch.sparkSession, f"{table}_batches"
    if batch_id is not None and is_noted(spark, log, stream, batch_id):
        return False
    # Written once: its ids are looked up before its rows are joined, and a stream's source is read a single time.
    rows = materialize(to_store_rows(batch, settings).dropDuplicates(["audio_id", "chunk_index"]), "batch")
    held = in_buckets_of(at_settings(read_buckets(spark, table), settings), rows.select("audio_id"))
    fresh = rows.join(held.select("audio_id", "chunk_index"), ["audio_id", "chunk_index"], "left_anti")
    append_rows(fresh.select(*rows.columns), table)
    if batch_id is not None:
        note = spark.range(1).select(F.lit(stream).alias("stream"), F.lit(batch_id).cast("long").alias("batch_id"), F.current_timestamp().alias("noted_at"))
        write_table(note, log, "append", ["stream", "batch_id"])
    return True


def is_noted(spark: SparkSession, log: str, stream: str, batch_id: int) -> bool:
    """Whether a batch is in the log: of a path, its own folder is looked for, whatever the length of the log."""
    if "/" in log:
        return not read_or_empty(spark, f"{log}/stream={stream}/batch_id={batch_id}", "noted_at timestamp").isEmpty()
    entries = read_or_empty(spark, log, "noted_at timestamp, stream string, batch_id long")
    return not entries.filter((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty()


def read_embeddings(ids: DataFrame, store: DataFrame, settings: EmbeddingSettings) -> DataFrame:
    """Stored chunks of the wanted ids with the columns of ``ids``; a repeated id repeats its chunks."""
    chunks = at_settings(store, settings).select(
        F.col("audio_id"), "chunk_index", F.col("embedding").alias("features"),
        F.col("species_name").alias("stored_species_name"),
    )
    return ids.join(chunks, ids["id"].cast("string") == chunks["audio_id"]).drop("audio_id")


def incremental_features(wanted: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split wanted chunks ``(id, chunk_index, ...)`` by what the feature store holds.

    Returns ``(hits, to_do, hit_counts)``: hits carry the stored features and the label
    columns of the wanted row; ``hit_counts`` has one row ``(wanted, hits, to_do)``.
    """
    keys = ["id", "chunk_index"]
    # A key stored twice counts once: its features are those of the greatest vector, whatever the order of the rows.
    held = store.groupBy(*keys).agg(F.max("features").alias("features"))
    # Counts and misses need the keys alone; the vectors are read where the hits are.
    known = store.select(*keys).distinct()
    marked = wanted.select(*keys).join(known.withColumn("_held", F.lit(True)), keys, "left")
    is_hit = F.col("_held").isNotNull()
    counts = marked.agg(F.count(F.lit(1)).alias("wanted"), F.count_if(is_hit).alias("hits"), F.count_if(~is_hit).alias("to_do"))
    return wanted.join(held, keys), wanted.join(known, keys, "left_anti"), counts


def merge_feature_sources(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored and fresh features below each other; a column missing on one side is null there."""
    return stored.unionByName(fresh, allowMissingColumns=True)


def retain_features(
    store: DataFrame, keep_ids: DataFrame, keep_formats: list[str] | None = None,
    allow_empty_keep: bool = False, id_col: str = "id", format_col: str = "format",
) -> tuple[DataFrame, DataFrame]:
    """``(kept, removed)`` rows by exact id and, if given, by format.

    ``versions.rewrite_retained`` keeps the result as a new version of a stored table. An
    empty keep list would remove everything and needs ``allow_empty_keep``.
    """
    ids = keep_ids.select(F.trim(F.col(id_col).cast("string")).alias("_keep")).distinct()
    wanted = materialize(ids, "keep-ids")
    if not allow_empty_keep and wanted.isEmpty():
        raise ValueError("empty keep list: pass allow_empty_keep=True to remove everything")
    match = F.trim(F.col(id_col).cast("string")) == F.col("_keep")
    if keep_formats is None:
        return store.join(wanted, match, "left_semi"), store.join(wanted, match, "left_anti")
    fits = F.coalesce(F.lower(format_col).isin([f.lower() for f in keep_formats]), F.lit(False))
    kept = store.filter(fits).join(wanted, match, "left_semi")
    marked = store.join(wanted, match, "left").withColumn("_fits", fits)
    removed = marked.filter(F.col("_keep").isNull() | ~F.col("_fits")).drop("_keep", "_fits")
    return kept, removed
