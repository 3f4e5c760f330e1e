"""Queries over pooling, metrics, learning, monitoring and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reedbed.config import EvaluationSettings
from reedbed.functions.columns import argmax
from reedbed.operators import learn, metrics, monitor, pooling
from reedbed.plans import fixtures as fx
from reedbed.plans import sql as q
from reedbed.plans.registry import ORACLES, query
from reedbed.session import scratch_dir
from reedbed.sources.embeddings import STORE_COLUMNS, read_store
from reedbed.streaming import jobs

C = fx.N_CLASSES


# --- pooling ---------------------------------------------------------------------------


@query("chunk_argmax", f"WITH {q.CHUNKS} SELECT recording_id, chunk_index, pred AS y_pred FROM voted")
def _(spark, sf_dir):
    return pooling.chunk_argmax(fx.chunk_probs(spark, sf_dir)).select("recording_id", "chunk_index", "y_pred")


def _pool_query(name, sql, fn):
    @query(name, sql)
    def _(spark, sf_dir):
        return fn(fx.chunk_probs(spark, sf_dir))


_BEST = """, best AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY conf DESC, chunk_index) AS rn FROM voted) WHERE rn <= {k})"""
_pool_query("pool_mean", f"WITH {q.pooled()} {q.REC_SHOWN}", lambda df: pooling.pool_mean(df, C))
_pool_query(
    "pool_max",
    f"""WITH {q.CHUNKS}, {q.META} {_BEST.format(k=1)},
    rec AS (SELECT b.recording_id, b.pred AS y_pred, b.conf AS confidence, m.num_chunks, b.probs, m.y_true
      FROM best b JOIN meta m ON m.recording_id = b.recording_id) {q.REC_SHOWN}""",
    lambda df: pooling.pool_max(df, C),
)
_pool_query(
    "pool_voting",
    f"""WITH {q.pooled()}, votes AS (SELECT recording_id, pred, count(*) AS n, min(chunk_index) AS seen FROM voted GROUP BY 1, 2),
    won AS (SELECT recording_id, pred FROM votes QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY n DESC, seen) = 1)
    SELECT r.recording_id, w.pred AS y_pred, round(r.probs[w.pred + 1], 6) AS confidence, num_chunks,
      {q.decimals('probs')} AS probs, y_true FROM rec r JOIN won w ON w.recording_id = r.recording_id""",
    lambda df: pooling.pool_voting(df, C),
)
_pool_query(
    "pool_topk",
    f"""WITH {q.pooled(source='(SELECT * FROM voted QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY conf DESC, chunk_index) <= 3)')}
    {q.REC_SHOWN}""",
    lambda df: pooling.pool_topk(df, C, 3),
)
_pool_query("pool_softmax", f"WITH {q.pooled('exp(conf)')} {q.REC_SHOWN}", lambda df: pooling.pool_softmax(df, C))
_pool_query(
    "eval_override",
    f"""WITH {q.pooled()}, hits AS (
      SELECT recording_id, bool_or(pred = y_true) AS hit, arg_min(pred, chunk_index) AS first FROM voted GROUP BY 1)
    SELECT r.recording_id, CASE WHEN hit THEN y_true ELSE first END AS y_pred, round(confidence, 6) AS confidence, num_chunks,
      {q.decimals('probs')} AS probs, y_true FROM rec r JOIN hits h ON h.recording_id = r.recording_id""",
    lambda df: pooling.eval_override(df, C),
)


@query(
    "recording_predictions",
    f"""WITH {q.pooled()} SELECT recording_id, num_chunks, round(confidence, 6) AS confidence, 'mean' AS pooling_strategy,
    CASE WHEN confidence >= 0.3 THEN ({q.M})[y_pred + 1] ELSE 'LOW_CONFIDENCE' END AS predicted_species,
    CASE WHEN confidence >= 0.3 THEN y_pred ELSE -1 END AS predicted_class, ({q.M})[y_true + 1] AS true_species,
    array_to_string(list_transform(range(10), lambda i: ({q.M})[i + 1] || '=' || CAST(CAST(probs[i + 1] AS DECIMAL(18,6)) AS VARCHAR)), ',')
      AS prob_by_species FROM rec""",
)
def _(spark, sf_dir):
    rows = pooling.recording_predictions(fx.chunk_probs(spark, sf_dir), fx.MAPPING, C, "mean", threshold=0.3)
    entry = F.transform(
        F.map_entries("prob_by_species"),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("decimal(18,6)").cast("string")),
    )
    return rows.select(
        "recording_id", "num_chunks", "confidence", "pooling_strategy", "predicted_species", "predicted_class", "true_species",
        entry.alias("prob_by_species"),
    )


# --- label metrics ---------------------------------------------------------------------


def _metric_query(name, sql, fn):
    @query(name, f"WITH {q.pooled()}{sql}")
    def _(spark, sf_dir):
        return fn(pooling.pool_mean(fx.chunk_probs(spark, sf_dir), C))


_GRID = """, classes AS (SELECT y_true AS c FROM rec UNION SELECT y_pred FROM rec),
cells AS (SELECT t.c AS y_true, p.c AS y_pred, (SELECT count(*) FROM rec r WHERE r.y_true = t.c AND r.y_pred = p.c) AS count
  FROM classes t, classes p)"""
_metric_query("confusion_counts", f"{_GRID} SELECT * FROM cells", metrics.confusion_counts)
_metric_query(
    "confusion_normalized",
    f"""{_GRID} SELECT y_true, y_pred,
    round(CAST(count AS DOUBLE) / nullif(sum(count) OVER (PARTITION BY y_true), 0), 6) AS share FROM cells""",
    metrics.confusion_normalized,
)


def _per_class(source: str) -> str:
    """CTE ``pc``: precision, recall, f1, support of the classes in ``source(c)``."""
    return f""", n0 AS (SELECT c, (SELECT count(*) FROM rec WHERE y_true = c AND y_pred = c) AS tp,
  (SELECT count(*) FROM rec WHERE y_pred = c) AS predicted, (SELECT count(*) FROM rec WHERE y_true = c) AS support FROM {source}),
pc AS (SELECT CAST(c AS INTEGER) AS c, tp, support, coalesce(CAST(tp AS DOUBLE) / nullif(predicted, 0), 0) AS p,
  coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0) AS r,
  coalesce(2 * CAST(tp AS DOUBLE) / nullif(predicted + support, 0), 0) AS f FROM n0)"""


_PRESENT = ", classes AS (SELECT y_true AS c FROM rec UNION SELECT y_pred FROM rec)" + _per_class("classes")
_metric_query(
    "per_class_metrics",
    f"""{_per_class('(SELECT unnest(range(16)) AS c)')}
    SELECT c AS class_label, ({q.M})[c + 1] AS species_name, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support
    FROM pc""",
    lambda df: metrics.per_class_metrics(df, fx.MAPPING),
)
_metric_query(
    "global_metrics",
    f"""{_PRESENT} SELECT round(CAST(sum(tp) AS DOUBLE) / sum(support), 6) AS accuracy, round(avg(f), 6) AS f1_macro,
    round(sum(f * support) / sum(support), 6) AS f1_weighted, round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro FROM pc""",
    metrics.global_metrics,
)
_REPORT = f"""{_PRESENT}, rep AS (
  SELECT false AS is_summary, CAST(c AS INTEGER) AS position, ({q.M})[c + 1] AS label, p AS precision, r AS recall, f AS f1,
    CAST(support AS DOUBLE) AS support FROM pc
  UNION ALL SELECT true, 0, 'accuracy', a, a, a, a FROM (SELECT CAST(sum(tp) AS DOUBLE) / sum(support) AS a FROM pc)
  UNION ALL SELECT true, 1, 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS DOUBLE) FROM pc
  UNION ALL SELECT true, 2, 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
    sum(f * support) / sum(support), CAST(sum(support) AS DOUBLE) FROM pc)
SELECT is_summary, position, label, round_even(precision, 3) AS precision, round_even(recall, 3) AS recall, round_even(f1, 3) AS f1,
  round_even(support, 3) AS support FROM rep"""
_metric_query("classification_report", _REPORT, lambda df: metrics.classification_report(df, fx.MAPPING))
_metric_query(
    "classes_by_f1",
    f"{_REPORT} WHERE NOT is_summary",
    lambda df: metrics.classes_by_f1(metrics.classification_report(df, fx.MAPPING)),
)

# --- score metrics ---------------------------------------------------------------------

_LONG = """, long AS (SELECT CAST(unnest(range(10)) AS INTEGER) AS class_label, unnest(probs) AS score, y_true FROM rec),
ovr AS (SELECT class_label, score, class_label = y_true AS is_true FROM long)"""
_POINTS = f"""{_LONG}, g AS (SELECT class_label, score, count(*) FILTER (WHERE is_true) AS pos,
  count(*) FILTER (WHERE NOT is_true) AS neg FROM ovr GROUP BY 1, 2),
pts AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER a AS p, sum(neg) OVER a AS n FROM g
  WINDOW w AS (PARTITION BY class_label ORDER BY score DESC ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY class_label))"""
# Every pair of a positive and a negative is compared here.
_AUC = f"""{_LONG}, auc AS (
  SELECT k.class_label, (SELECT CAST(sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) AS DOUBLE)
      / nullif(count(*), 0) FROM ovr a, ovr b WHERE a.class_label = k.class_label AND b.class_label = k.class_label
      AND a.is_true AND NOT b.is_true) AS roc_auc
  FROM (SELECT DISTINCT class_label FROM ovr) k)"""
_AP = f"""{_POINTS}, ap AS (SELECT class_label, CAST(sum(pos * CAST(tp AS DOUBLE) / (tp + fp)) / nullif(max(p), 0) AS DOUBLE) AS pr_auc
  FROM pts GROUP BY 1)"""
_metric_query(
    "roc_auc_per_class", f"{_AUC} SELECT class_label, round(roc_auc, 6) AS roc_auc FROM auc", metrics.roc_auc_per_class
)
_metric_query(
    "roc_auc_macro",
    f"{_AUC} SELECT round(CASE WHEN count(roc_auc) = count(*) THEN avg(roc_auc) END, 6) AS roc_auc_macro FROM auc",
    metrics.roc_auc_macro,
)
_metric_query(
    "average_precision_per_class",
    f"{_AP} SELECT class_label, round(pr_auc, 6) AS pr_auc FROM ap",
    metrics.average_precision_per_class,
)
_metric_query(
    "average_precision_macro",
    f"{_AP} SELECT round(CASE WHEN count(pr_auc) = count(*) THEN avg(pr_auc) END, 6) AS pr_auc_macro FROM ap",
    metrics.average_precision_macro,
)


def _whole_and_thin(curve):
    """A curve with all its points and without those on a straight stretch."""

    def both(df):
        return curve(df).withColumn("points", F.lit("all")).unionByName(curve(df, thin=True).withColumn("points", F.lit("corners")))

    return both


# Steps before and behind a point, in counts; the step before the first point begins at nothing.
_TURNS = f"""{_POINTS}, turns AS (SELECT *, tp - pos AS tp0, fp - neg AS fp0, lead(pos) OVER w AS pos1, lead(neg) OVER w AS neg1 FROM pts
  WINDOW w AS (PARTITION BY class_label ORDER BY score DESC)),
steps AS (SELECT *, CASE WHEN tp0 + fp0 = 0 THEN fp = 0 ELSE tp * (tp0 + fp0) = tp0 * (tp + fp) END AS level_in,
  tp * (tp + pos1 + fp + neg1) = (tp + pos1) * (tp + fp) AS level_out FROM turns WHERE p > 0)"""
_metric_query(
    "roc_curve",
    f"""{_TURNS}, shown AS (SELECT 'all' AS points, * FROM steps
      UNION ALL SELECT 'corners', * FROM steps WHERE pos1 IS NULL OR pos * neg1 <> pos1 * neg)
    SELECT points, class_label, round(score, 6) AS threshold, round(CAST(fp AS DOUBLE) / nullif(n, 0), 6) AS fpr,
      round(CAST(tp AS DOUBLE) / p, 6) AS tpr FROM shown
    UNION ALL SELECT DISTINCT points, class_label, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM shown""",
    _whole_and_thin(metrics.roc_curve),
)
_metric_query(
    "pr_curve",
    f"""{_TURNS}, shown AS (SELECT 'all' AS points, * FROM steps
      UNION ALL SELECT 'corners', * FROM steps WHERE pos1 IS NULL OR NOT ((pos = 0 AND pos1 = 0) OR (level_in AND level_out)))
    SELECT points, class_label, round(score, 6) AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
      round(CAST(tp AS DOUBLE) / p, 6) AS recall FROM shown
    UNION ALL SELECT DISTINCT points, class_label, CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE) FROM shown""",
    _whole_and_thin(metrics.pr_curve),
)
_metric_query(
    "pr_auc_trapezoid",
    f"""{_POINTS}, xy AS (SELECT class_label, score, CAST(tp AS DOUBLE) / p AS x, CAST(tp AS DOUBLE) / (tp + fp) AS y FROM pts WHERE p > 0),
    steps AS (SELECT class_label, x - coalesce(lag(x) OVER w, 0) AS dx, (y + coalesce(lag(y) OVER w, 1)) / 2 AS h FROM xy
      WINDOW w AS (PARTITION BY class_label ORDER BY score DESC))
    SELECT class_label, round(sum(dx * h), 6) AS pr_auc_trapezoid FROM steps GROUP BY 1""",
    metrics.pr_auc_trapezoid,
)
_metric_query(
    "drop_unseen_classes",
    f"""{_LONG} SELECT class_label, round(score, 6) AS score, is_true FROM ovr
    WHERE class_label IN (SELECT y_true FROM rec WHERE y_true < 5)""",
    lambda df: metrics.drop_unseen_classes(df.filter("y_true < 5"), metrics.one_vs_rest(df)),
)
_metric_query(
    "top_k_accuracy",
    """ SELECT round(avg(CASE WHEN len(list_filter(probs, lambda x: x > probs[y_true + 1])) < 3 THEN 1.0 ELSE 0.0 END), 6)
    AS top_k_accuracy FROM rec""",
    metrics.top_k_accuracy,
)


# For each frame: its row names, its numbers, and the rows of the SQL that computes it alone.
_FRAMES = {
    "recording_predictions": (("recording_id",), ("num_chunks", "confidence", "predicted_class"), ""),
    "confusion_counts": (("y_true", "y_pred"), ("count",), ""),
    "confusion_normalized": (("y_true", "y_pred"), ("share",), ""),
    "per_class_metrics": (("class_label", "species_name"), ("precision", "recall", "f1", "support"), ""),
    "global_metrics": ((), ("accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro"), ""),
    "classification_report": (("label",), ("precision", "recall", "f1", "support"), ""),
    "roc_auc_per_class": (("class_label",), ("roc_auc",), ""),
    "roc_auc_macro": ((), ("roc_auc_macro",), ""),
    "average_precision_per_class": (("class_label",), ("pr_auc",), ""),
    "average_precision_macro": ((), ("pr_auc_macro",), ""),
    "roc_curve": (("class_label",), ("num_points", "threshold", "fpr", "tpr"), "points = 'all'"),
    "pr_curve": (("class_label",), ("num_points", "threshold", "precision", "recall"), "points = 'all'"),
    "pr_auc_trapezoid": (("class_label",), ("pr_auc_trapezoid",), ""),
    "top_k_accuracy": ((), ("top_k_accuracy",), ""),
}
_CURVES = ("roc_curve", "pr_curve")  # compared by the sums of their columns


def _frame_sql(frame):
    keys, numbers, kept = _FRAMES[frame]
    rows = f"(SELECT * FROM ({ORACLES[frame]}) WHERE {kept or 'true'})"
    if frame == "recording_predictions":  # the run has no confidence threshold
        rows = f"(WITH {q.pooled()} SELECT recording_id, num_chunks, confidence, y_pred AS predicted_class FROM rec)"
    if frame in _CURVES:
        sums = ", ".join(f"sum({c}) AS {c}" for c in numbers[1:])
        rows = f"(SELECT class_label, count(*) AS num_points, {sums} FROM {rows} GROUP BY 1)"
    row = " || '/' || ".join(f"CAST({k} AS VARCHAR)" for k in keys) or "''"
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in numbers)
    return f"SELECT '{frame}' AS frame, {row} AS name, unnest({q.sql_list(numbers)}) AS measure, unnest([{values}]) AS value FROM {rows}"


def _frame_rows(frame, df):
    keys, numbers, _ = _FRAMES[frame]
    if frame in _CURVES:
        sums = [F.sum(F.round(c, 6)).alias(c) for c in numbers[1:]]
        df = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_points"), *sums)
    row = F.concat_ws("/", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    entries = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in numbers])
    return df.select(F.lit(frame).alias("frame"), row.alias("name"), F.inline(entries))


@query(
    "evaluate",
    "SELECT frame, name, measure, round(value, 6) AS value FROM ("
    + " UNION ALL ".join(_frame_sql(frame) for frame in _FRAMES)
    + ")",
)
def _(spark, sf_dir):
    frames = metrics.evaluate(fx.chunk_probs(spark, sf_dir), fx.MAPPING, EvaluationSettings(n_classes=C))
    return reduce(DataFrame.unionByName, [_frame_rows(name, df) for name, df in frames.items()])


# --- learning --------------------------------------------------------------------------

_HIDDEN = 16


def _train(spark, sf_dir):
    return learn.train_mlp(fx.features(spark, sf_dir), hidden=_HIDDEN, max_iter=10)


_SHAPE = "shape AS (SELECT count(DISTINCT label) AS c, max(len(embedding)) AS d, count(*) AS n FROM embeddings)"


@query(
    "train_mlp",
    f"""WITH {_SHAPE} SELECT CAST(d AS INTEGER) AS input_width, CAST(c AS INTEGER) AS num_classes,
    CAST(d * {_HIDDEN} + {_HIDDEN} + {_HIDDEN} * c + c AS INTEGER) AS num_weights, n AS rows_scored FROM shape""",
)
def _(spark, sf_dir):
    model = _train(spark, sf_dir)
    scored = learn.score_chunks(model, fx.features(spark, sf_dir))
    return scored.agg(
        F.lit(model.numFeatures).alias("input_width"),
        F.lit(model.numClasses).alias("num_classes"),
        F.lit(len(model.weights)).alias("num_weights"),
        F.count(F.lit(1)).alias("rows_scored"),
    )


@query("score_chunks", f"WITH {_SHAPE} SELECT vec_id, CAST(c AS INTEGER) AS num_probs, CAST(1 AS DOUBLE) AS prob_sum FROM embeddings, shape")
def _(spark, sf_dir):
    """Weights depend on the optimiser, so the check is that each chunk gets a full distribution."""
    scored = learn.score_chunks(_train(spark, sf_dir), fx.features(spark, sf_dir))
    total = F.aggregate("probs", F.lit(0.0), lambda a, b: a + b)
    return scored.select("vec_id", F.size("probs").alias("num_probs"), total.alias("prob_sum"))


@query("features_to_vector", f"SELECT vec_id, {q.decimals('embedding')} AS vector FROM embeddings")
def _(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    width = fx.features(spark, sf_dir).transform(learn.training_classes).first()["input_width"]
    vectors = learn.features_to_vector(fx.features(spark, sf_dir), width)
    return vectors.select("vec_id", vector_to_array("vector").alias("vector"))


@query("training_classes", f"WITH {_SHAPE} SELECT c AS num_classes, CAST(d AS INTEGER) AS input_width FROM shape")
def _(spark, sf_dir):
    return learn.training_classes(fx.features(spark, sf_dir))


# --- monitoring ------------------------------------------------------------------------


@query("daily_metric", f"WITH {q.DAILY} SELECT day, model_id, round(rmse, 6) AS rmse, num_predictions FROM daily")
def _(spark, sf_dir):
    return monitor.daily_metric(fx.preds(spark, sf_dir))


@query(
    "metric_violation",
    f"""WITH {q.DAILY}, recent AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY day DESC) AS rn FROM daily)
    SELECT model_id, count(*) AS windows, count(*) FILTER (WHERE rmse > 50) AS violations,
      count(*) FILTER (WHERE rmse > 50) >= 2 AS is_violated FROM recent WHERE rn <= 5 GROUP BY 1""",
)
def _(spark, sf_dir):
    return monitor.metric_violation(monitor.daily_metric(fx.preds(spark, sf_dir)), threshold=50.0)


# --- streams ---------------------------------------------------------------------------


def _as_stream(df, name):
    """The rows of ``df`` as a file stream."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


@query(
    "stream_daily_metric",
    f"""WITH {q.DAILY} SELECT day, model_id, round(rmse, 6) AS rmse, num_predictions FROM daily
    WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM preds) - INTERVAL 1 HOUR""",
)
def _(spark, sf_dir):
    """Only days the watermark has closed come out."""
    out = scratch_dir(spark, "daily")
    daily = jobs.stream_daily_metric(_as_stream(fx.preds(spark, sf_dir), "preds"))
    jobs.write_stream(daily, out, scratch_dir(spark, "daily-checkpoint")).awaitTermination()
    return spark.read.schema(daily.schema).parquet(out)


@query(
    "stream_append_embeddings",
    f"""WITH {q.FEATURES} SELECT CAST(id AS VARCHAR) AS audio_id, chunk_index, 'stack' AS embedding_strategy, species_name,
    'net' AS embedding_from, CAST(3.0 AS FLOAT) AS window_sec, CAST(0.0 AS FLOAT) AS overlap_window_sec FROM features""",
)
def _(spark, sf_dir):
    """The stream is replayed from the start; the store holds every chunk once."""
    store = scratch_dir(spark, "stream-store")
    rows = _as_stream(fx.features(spark, sf_dir), "features")
    for _ in range(2):
        run = jobs.stream_append_embeddings(rows, store, fx.SETTINGS, scratch_dir(spark, "store-checkpoint"))
        run.awaitTermination()
    return read_store(spark, store).select(*[c for c in STORE_COLUMNS if c != "embedding"])


@query("stream_score", f"WITH {q.CHUNKS} SELECT vec_id, pred AS y_pred, {q.decimals('probs')} AS probs FROM voted")
def _(spark, sf_dir):
    def scorer(df):
        return fx.chunk_scorer(df).select("vec_id", argmax(F.col("probs")).alias("y_pred"), "probs")

    out = scratch_dir(spark, "stream-scores")
    stream = _as_stream(fx.chunks(spark, sf_dir), "stream-chunks")
    jobs.stream_score(stream, scorer, out, scratch_dir(spark, "score-checkpoint")).awaitTermination()
    return spark.read.schema(scorer(stream).schema).parquet(out)


@query(
    "merge_feature_sources",
    f"""WITH {q.FEATURES} SELECT id, chunk_index, CASE WHEN is_held THEN 'stored' ELSE 'fresh' END AS source,
    CASE WHEN is_held THEN CAST(NULL AS INTEGER) ELSE class_label END AS class_label FROM features""",
)
def _(spark, sf_dir):
    from reedbed.sources.embeddings import merge_feature_sources

    rows = fx.features(spark, sf_dir)
    stored = rows.filter("is_held").select("id", "chunk_index", F.lit("stored").alias("source"))
    fresh = rows.filter(~F.col("is_held")).select("id", "chunk_index", F.lit("fresh").alias("source"), "class_label")
    return merge_feature_sources(stored, fresh)
