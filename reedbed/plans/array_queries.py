"""Queries over framing, normalising, segment pooling and feature extraction."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from reedbed.operators import arrays
from reedbed.plans import fixtures as fx
from reedbed.plans import sql as q
from reedbed.plans.registry import query
from reedbed.session import materialize

_WAVES = "waves AS (SELECT vec_id AS id, list_concat(embedding, embedding[1:vec_id % 32]) AS y FROM embeddings)"
_ZEROS = "list_transform(range({n}), lambda i: CAST(0 AS FLOAT))"


@query(
    "frame_single",
    f"""WITH {_WAVES} SELECT id, {q.decimals(f"list_concat(y, {_ZEROS.format(n=32)})[1:32]")} AS y FROM waves""",
)
def _(spark, sf_dir):
    return arrays.frame_single(fx.waveforms(spark, sf_dir), 32)


def _frames_sql(n: int, hop: int, limit: str, chunks: int) -> str:
    padded = f"list_concat(y[i * {hop} + 1:i * {hop} + {n}], {_ZEROS.format(n=n)})[1:{n}]"
    return f"""SELECT id, CAST(i AS INTEGER) AS chunk_index, {q.decimals(padded)} AS y
    FROM (SELECT id, y, {limit} AS m FROM waves) w, range({chunks}) r(i)
    WHERE i * {hop} < m AND (i = 0 OR (i - 1) * {hop} + {n} < m)"""


@query(
    "frame_sliding",
    f"""WITH {_WAVES} SELECT 'plain' AS setting, * FROM ({_frames_sql(12, 8, 'len(y)', 64)})
    UNION ALL SELECT 'limited', * FROM ({_frames_sql(5, 7, 'least(len(y), 30)', 4)})""",
)
def _(spark, sf_dir):
    waves = fx.waveforms(spark, sf_dir)
    plain = arrays.frame_sliding(waves, 12, 8).withColumn("setting", F.lit("plain"))
    limited = arrays.frame_sliding(waves, 5, 7, max_samples=30, max_chunks=4).withColumn("setting", F.lit("limited"))
    return plain.unionByName(limited).select("setting", "id", "chunk_index", "y")


_LEVELS = "levels AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 400 - 40) AS features FROM embeddings)"


def _levels(spark, sf_dir):
    scaled = F.transform("embedding", lambda x: x.cast("double") * 400 - 40)
    return fx.table(spark, sf_dir, "embeddings").select("vec_id", scaled.alias("features"))


@query(
    "normalize_db_clip",
    f"""WITH {_LEVELS} SELECT vec_id, {q.decimals('list_transform(features, lambda x: least(greatest(x, -80), 0) / 80.0)')} AS features
    FROM levels""",
)
def _(spark, sf_dir):
    return arrays.normalize_db_clip(_levels(spark, sf_dir))


@query(
    "normalize_minmax",
    f"""WITH {_LEVELS} SELECT vec_id, {q.decimals(
        'list_transform(features, lambda x: (x - list_min(features)) / (list_max(features) - list_min(features) + 1e-8))')} AS features
    FROM levels""",
)
def _(spark, sf_dir):
    return arrays.normalize_minmax(_levels(spark, sf_dir))


@query(
    "downmix",
    f"""SELECT vec_id, {q.decimals(
        'list_transform(range(1, 33), lambda i: (CAST(embedding[i] AS DOUBLE) + embedding[i + 32]) / 2)')} AS y FROM embeddings""",
)
def _(spark, sf_dir):
    channels = F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))
    rows = fx.table(spark, sf_dir, "embeddings").select("vec_id", channels.alias("channels"))
    return arrays.downmix(rows).select("vec_id", "y")


@query(
    "pool_segments_mean",
    f"""WITH {q.FEATURES}, d AS (SELECT id, unnest(range(64)) AS i, unnest(features) AS x FROM features),
    m AS (SELECT id, i, avg(CAST(x AS DOUBLE)) AS x, count(*) AS num_segments FROM d GROUP BY 1, 2)
    SELECT id, max(num_segments) AS num_segments, {q.decimals('list(x ORDER BY i)')} AS features FROM m GROUP BY 1""",
)
def _(spark, sf_dir):
    return arrays.pool_segments_mean(fx.features(spark, sf_dir))


@query(
    "stack_segments",
    f"""SELECT vec_id, CAST(i AS INTEGER) AS chunk_index, {q.decimals('embedding[i * 16 + 1:i * 16 + 16]')} AS features
    FROM embeddings, range(4) r(i)""",
)
def _(spark, sf_dir):
    segments = F.array(*[F.slice("embedding", 1 + 16 * i, 16) for i in range(4)])
    rows = fx.table(spark, sf_dir, "embeddings").select("vec_id", segments.alias("segments"))
    return arrays.stack_segments(rows)


def _signal_features(batch):
    """Peak, trough and length of the signals of a batch; short signals are refused."""
    y = batch.column("y")
    sizes = pc.list_value_length(y).to_numpy()
    if (sizes < 66).any():
        raise ValueError("signal too short")
    values, starts = y.flatten().to_numpy(), np.cumsum(sizes) - sizes
    table = np.stack([np.maximum.reduceat(values, starts), np.minimum.reduceat(values, starts), sizes], axis=1)
    features = pa.ListArray.from_arrays(np.arange(0, 3 * len(sizes) + 1, 3, dtype="int32"), pa.array(table.ravel().astype("float32")))
    rows = pa.array(np.arange(len(sizes)))
    return pa.RecordBatch.from_arrays([rows, pa.array(np.zeros(len(sizes), "int32")), features], ["row", "chunk_index", "features"])


def _extracted(waves):
    return arrays.extract_features(waves, arrays.batch_extractor(_signal_features), weight=4 * F.size("y"))


@query(
    "extract_features",
    f"""WITH {_WAVES} SELECT id, CASE WHEN len(y) >= 66 THEN CAST(0 AS INTEGER) END AS chunk_index,
    CASE WHEN len(y) >= 66 THEN {q.decimals('[CAST(list_max(y) AS DOUBLE), list_min(y), len(y)]')} END AS features,
    CASE WHEN len(y) < 66 THEN 'ValueError: signal too short' END AS error FROM waves""",
)
def _(spark, sf_dir):
    return _extracted(fx.waveforms(spark, sf_dir))


@query(
    "preprocessing_summary",
    f"""WITH {_WAVES} SELECT count(*) AS total_input, count(*) FILTER (WHERE len(y) < 66) AS failed_count,
    count(*) FILTER (WHERE len(y) > 80) AS skipped_cached_count, count(*) FILTER (WHERE len(y) >= 66) AS final_output FROM waves""",
)
def _(spark, sf_dir):
    waves = fx.waveforms(spark, sf_dir)
    good, failed = arrays.split_failures(materialize(_extracted(waves), "extracted"))
    return arrays.preprocessing_summary(waves, good, failed, waves.filter("size(y) > 80"))
