"""Framing, normalising and pooling of array-valued signals and features."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reedbed.functions.ordering import hash_key, running_totals
from reedbed.session import materialize


def _padded(signal: Column, start: Column | int, n: int) -> Column:
    """``n`` samples from 0-based ``start``, zeros past the end."""
    part = F.slice(signal, F.lit(start) + 1 if isinstance(start, int) else start + 1, n)
    return F.concat(part, F.array_repeat(F.lit(0.0).cast("float"), n - F.size(part)))


def frame_single(df: DataFrame, n: int, col: str = "y") -> DataFrame:
    """Pad with zeros or cut to ``n`` samples."""
    return df.withColumn(col, _padded(F.col(col), 0, n))


def frame_sliding(
    df: DataFrame, n: int, hop: int | None, max_samples: int | None = None, max_chunks: int | None = None, col: str = "y"
) -> DataFrame:
    """One row per frame: ``chunk_index`` and the frame in ``col``.

    Frames start every ``hop`` samples below the limit (signal length or
    ``max_samples``) until one reaches the limit. The limit bounds starts only: a frame
    reads on past it. Without a hop there is one padded or cut frame.
    """
    if hop is None:
        return frame_single(df, n, col).withColumn("chunk_index", F.lit(0))
    limit = F.least(F.size(col), F.lit(max_samples)) if max_samples else F.size(col)
    frames = F.least(
        F.greatest(F.ceil((limit - n) / hop) + 1, F.lit(1)),  # first frame that reaches the limit
        F.ceil(limit / hop),  # starts below the limit
    )
    if max_chunks is not None:
        frames = F.least(frames, F.lit(max_chunks))
    indexes = F.when(frames > 0, F.sequence(F.lit(0), (frames - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    placed = df.withColumn("chunk_index", F.explode(indexes))
    return placed.withColumn(col, _padded(F.col(col), F.col("chunk_index") * hop, n))


def normalize_db_clip(df: DataFrame, col: str = "features") -> DataFrame:
    """Clip to [-80, 0] and divide by 80; the result lies in [-1, 0]. NaN stays NaN."""

    def scaled(x: Column) -> Column:
        clipped = F.least(F.greatest(x, F.lit(-80.0)), F.lit(0.0))  # NaN counts as largest here
        return F.when(F.isnan(x), x).otherwise(clipped / F.lit(80.0))

    return df.withColumn(col, F.transform(col, lambda x: scaled(x.cast("double"))))


def normalize_minmax(df: DataFrame, col: str = "features") -> DataFrame:
    """``(x - min) / (max - min + 1e-8)``; a constant array gives zeros; NaN is left out of min and max.

    An empty array, or one of NaN only, has no range and gives null.
    """
    values = F.transform(col, lambda x: x.cast("double"))
    known = F.filter(values, lambda x: ~F.isnan(x))
    low, high = F.array_min(known), F.array_max(known)
    close = high - low <= F.lit(1e-8) + F.lit(1e-5) * F.abs(high)
    scaled = F.transform(values, lambda x: (x - low) / (high - low + F.lit(1e-8)))
    zeros = F.transform(values, lambda x: F.lit(0.0))
    return df.withColumn(col, F.when(F.size(known) > 0, F.when(close, zeros).otherwise(scaled)))


def downmix(df: DataFrame, col: str = "channels", out: str = "y") -> DataFrame:
    """Mean over channels per sample; ``col`` is an array of equally long channels."""
    first = F.transform(F.col(col)[0], lambda x: x.cast("double"))
    rest = F.slice(col, 2, F.greatest(F.size(col) - 1, F.lit(0)))
    total = F.aggregate(rest, first, lambda acc, ch: F.zip_with(acc, ch, lambda a, b: a + b.cast("double")))
    return df.withColumn(out, F.transform(total, lambda x: x / F.size(col)))


def pool_segments_mean(df: DataFrame, id_col: str = "id", col: str = "features") -> DataFrame:
    """Mean vector per recording over its segment vectors.

    The vector mean is summed up in the JVM and combined before the shuffle, so a
    recording with very many segments sends one partial vector per task.
    """
    vectors = df.select(id_col, array_to_vector(F.transform(col, lambda x: x.cast("double"))).alias("_v"))
    pooled = vectors.groupBy(id_col).agg(Summarizer.mean(F.col("_v")).alias("_m"), F.count(F.lit(1)).alias("num_segments"))
    return pooled.select(id_col, "num_segments", vector_to_array("_m").alias(col))


def stack_segments(df: DataFrame, col: str = "segments", out: str = "features") -> DataFrame:
    """Array of vectors to one row per vector."""
    kept = [c for c in df.columns if c != col]
    return df.select(*kept, F.posexplode(col).alias("chunk_index", out))


# From batches with an ``id`` column to batches of ``FEATURE_SCHEMA``.
Extractor = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

FEATURE_SCHEMA = "id bigint, chunk_index int, features array<float>, error string"
_FEATURES = pa.schema(
    [("id", pa.int64()), ("chunk_index", pa.int32()), ("features", pa.list_(pa.float32())), ("error", pa.string())]
)


def _feature_batch(ids: pa.Array, chunk_index: pa.Array, features: pa.Array, errors: pa.Array) -> pa.RecordBatch:
    columns = zip((ids, chunk_index, features, errors), _FEATURES, strict=True)
    return pa.RecordBatch.from_arrays([col.cast(field.type) for col, field in columns], schema=_FEATURES)


def _message(exc: Exception) -> str:
    return f"{type(exc).__name__}: {exc}"


def per_row_extractor(extract: Callable[[dict], object]) -> Extractor:
    """A function from one row, as a dict, to a vector or to a list of vectors, as a batch extractor.

    An exception ends in the ``error`` column of that row. Where a whole batch can be computed at once,
    ``batch_extractor`` is much faster.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                try:
                    found = extract(row)
                    many = len(found) > 0 and hasattr(found[0], "__len__")
                    vectors = found if many else [found]
                    rows += [(row["id"], i, [float(x) for x in v], None) for i, v in enumerate(vectors)]
                except Exception as exc:  # noqa: BLE001 - the row is reported as failed
                    rows.append((row["id"], None, None, _message(exc)))
            columns = [pa.array([r[i] for r in rows], field.type) for i, field in enumerate(_FEATURES)]
            yield pa.RecordBatch.from_arrays(columns, schema=_FEATURES)

    return run


def batch_extractor(compute: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Extractor:
    """A function of a whole Arrow batch as a batch extractor.

    ``compute`` returns ``row`` (position in the batch), ``chunk_index`` and ``features``, and may raise if any row
    is bad. Then the halves of the batch are tried apart, and so on: only the rows that raise alone are
    reported as failed, and a batch with ``p`` of them is computed about ``p * log2(rows / p)`` more times.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [batch] if batch.num_rows else []
            while parts:
                part = parts.pop()
                ids = part.column("id")
                try:
                    found = compute(part)
                    done = _feature_batch(
                        ids.take(found.column("row").cast(pa.int64())), found.column("chunk_index"), found.column("features"), pa.nulls(found.num_rows)
                    )
                except Exception as exc:  # noqa: BLE001 - halved until the bad rows stand alone
                    if part.num_rows > 1:
                        half = part.num_rows // 2
                        parts += [part.slice(half), part.slice(0, half)]
                        continue
                    done = _feature_batch(ids, pa.nulls(1), pa.nulls(1), pa.array([_message(exc)]))
                yield done

    return run


TASK_BYTES = 64 << 20


def pack_by_weight(df: DataFrame, weight: Column, per_task: int, id_col: str = "id") -> DataFrame:
    """Spread rows over tasks of about ``per_task`` of ``weight`` each; ``weight`` is a number of the row, null as 0.

    Ids are cut by their hash into many small slices, 16 for each task or more. The running weight of the slices, a
    narrow aggregate, gives each slice its task, and every row is then sent to its slice's task by number. So
    tasks differ by the weight of one slice at most, however unevenly rows weigh. It rests on ``id_col`` being a key.
    """
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    narrow = df.select(text.alias("_id"), (F.greatest(F.coalesce(weight, F.lit(0)).cast("bigint"), F.lit(0)) + 1).alias("_w"))
    whole = narrow.agg(F.sum("_w")).first()[0] or 0
    tasks = max(1, math.ceil(whole / per_task))
    if tasks == 1:
        return df.repartition(1)
    digits = math.ceil(math.log(16 * tasks, 16))

    def slice_of(id_text: Column) -> Column:
        return F.conv(F.substring(hash_key(id_text, 0), 1, digits), 16, 10).cast("bigint")

    pieces = min(tasks, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = [16**digits * i // pieces for i in range(1, pieces)]
    slices = narrow.groupBy(slice_of(F.col("_id")).alias("_slice")).agg(F.sum("_w").alias("_w"))
    runs = running_totals(slices, [], "_slice", ["_w"], cuts, descending=False)
    task = F.floor((F.col("_w_run") - F.col("_w")) * tasks / F.col("_w_total")).cast("int")
    # Written, so its true size decides whether it is broadcast.
    placed = materialize(runs.select("_slice", F.least(task, F.lit(tasks - 1)).alias("_task")), "packing")
    return df.withColumn("_slice", slice_of(text)).join(placed, "_slice").repartitionById(tasks, "_task").select(*df.columns)


def extract_features(
    df: DataFrame, extractor: Extractor, schema: str = FEATURE_SCHEMA, partitions: int | None = None,
    weight: Column | None = None, per_task: int = TASK_BYTES,
) -> DataFrame:
    """Run a batch extractor over rows in Python workers, on Arrow batches.

    The work per row is heavy, so rows are spread evenly first: by ``weight`` (best the bytes of a row) in tasks of about
    ``per_task``, or by their number. The result holds features and errors side by side; write it once, then
    take both outputs with ``split_failures``.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartition(n) if weight is None else pack_by_weight(df, weight, per_task)
    return spread.mapInArrow(extractor, schema)


def split_failures(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(features, failed ids)``."""
    good = extracted.filter(F.col("error").isNull()).drop("error")
    return good, extracted.filter(F.col("error").isNotNull()).select("id", "error")


def preprocessing_summary(wanted: DataFrame, output: DataFrame, failed: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows in, failed, taken from the store, rows out: one row of four counts."""

    def tagged(df: DataFrame, tag: str) -> DataFrame:
        return df.select(F.lit(tag).alias("tag"))

    rows = tagged(wanted, "in").union(tagged(output, "out")).union(tagged(failed, "failed")).union(tagged(hits, "hit"))
    return rows.agg(
        F.count_if(F.col("tag") == "in").alias("total_input"),
        F.count_if(F.col("tag") == "failed").alias("failed_count"),
        F.count_if(F.col("tag") == "hit").alias("skipped_cached_count"),
        F.count_if(F.col("tag") == "out").alias("final_output"),
    )
