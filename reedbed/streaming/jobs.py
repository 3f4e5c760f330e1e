"""Streaming jobs: daily metric, embedding append, chunk scoring."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reedbed.config import EmbeddingSettings
from reedbed.operators.monitor import rmse
from reedbed.sources.embeddings import append_new_chunks


def stream_daily_metric(stream: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """The daily metric on a stream, for append mode: a day comes out once the watermark has passed it.

    Wall-clock ``ts`` is read as UTC, whatever the session's zone, so days match the batch form.
    """
    zone = F.current_timezone()
    instant = F.convert_timezone(F.lit("UTC"), zone, F.col("ts")).cast("timestamp")
    timed = stream.withColumn("ts", instant).withWatermark("ts", watermark)
    daily = timed.groupBy(F.window("ts", "1 day"), "model_id").agg(rmse(), F.count(F.lit(1)).alias("num_predictions"))
    day = F.convert_timezone(zone, F.lit("UTC"), F.col("window.start").cast("timestamp_ntz"))
    return daily.select(day.alias("day"), "model_id", "rmse", "num_predictions")


def stream_append_embeddings(
    stream: DataFrame, table: str, settings: EmbeddingSettings, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append streamed feature rows ``(id, chunk_index, features, species_name)`` to the store.

    A batch that is run again after a failure is known by its number, which is that of ``checkpoint``.
    """
    name = f"{zlib.crc32(checkpoint.encode()):08x}"
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, number: append_new_chunks(batch, table, settings, number, name)).start()


def stream_score(
    stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Score chunks as they arrive; recordings are pooled in batch on the sink."""
    return write_stream(scorer(stream), out, checkpoint, available_now)


def write_stream(df: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a Parquet folder, each row exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(out)
