"""Queries over sources, cleaning and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from reedbed.functions.columns import argmax, percent
from reedbed.operators import clean, derive, strategies
from reedbed.operators import anchors as an
from reedbed.plans import fixtures as fx
from reedbed.plans import sql as q
from reedbed.plans.registry import query
from reedbed.session import scratch_dir
from reedbed.sources import artifacts, embeddings, recordings, versions
from reedbed.sources.tables import write_table

# Fixed value: at the usual 100 no species of the fixture is rare.
RARE_BELOW = 350


def _kept(spark, sf_dir):
    return clean.clean_recordings(fx.parsed(spark, sf_dir))


def _named(spark, sf_dir):
    """Kept rows with the sorted names as ``species_names``."""
    return derive.sort_species(_kept(spark, sf_dir)).withColumn("species_names", F.col("validated_frog_names"))


# --- sources and sinks -----------------------------------------------------------------

_RAW_TEXT = (
    "id, call_audio, quality_call, state, capture_time, validated_frog_ids, validated_frog_names, "
    "is_duplicate, inappropriate_content, has_people_activity, validated_status"
)


@query("read_recordings", f"WITH {q.RAW} SELECT {_RAW_TEXT} FROM raw")
def _(spark, sf_dir):
    path = scratch_dir(spark, "recordings-csv")
    raw = fx.recordings_raw(spark, sf_dir)
    writer = raw.write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return derive.parse_capture_time(recordings.read_recordings(spark, path)).select(*_RAW_TEXT.split(", "))


@query(
    "require_columns",
    f"""WITH {q.RAW} SELECT {_RAW_TEXT}, CAST(NULL AS VARCHAR) AS filters_readable,
    CAST(NULL AS VARCHAR) AS validator_note_public, CAST(NULL AS VARCHAR) AS validator_note_private FROM raw""",
)
def _(spark, sf_dir):
    wider = fx.recordings_raw(spark, sf_dir).withColumn("not_required", F.lit(1))
    return recordings.require_columns(wider)


@query(
    "parse_list_columns",
    f"""WITH {q.RAW} SELECT id, {q.joined('names')} AS names, {q.joined('ids')} AS ids,
    CASE WHEN names IS NULL THEN CAST(NULL AS INTEGER) ELSE CAST(len(names) AS INTEGER) END AS n FROM raw""",
)
def _(spark, sf_dir):
    return fx.parsed(spark, sf_dir).select(
        "id", F.col("validated_frog_names").alias("names"), F.col("validated_frog_ids").alias("ids"),
        F.size("validated_frog_names").alias("n"),
    )


_STORED = """CAST(id AS VARCHAR) AS audio_id, chunk_index, 'stack' AS embedding_strategy, species_name,
  'net' AS embedding_from, CAST(3.0 AS FLOAT) AS window_sec, CAST(0.0 AS FLOAT) AS overlap_window_sec"""


def _store_columns(df):
    return df.select(*[c for c in embeddings.STORE_COLUMNS if c != "embedding"])


@query("write_embeddings", f"WITH {q.FEATURES} SELECT {_STORED} FROM features")
def _(spark, sf_dir):
    """The first classes, then all: the second write adds the others only."""
    path, rows = scratch_dir(spark, "embeddings"), fx.features(spark, sf_dir)
    embeddings.write_embeddings(rows.filter("class_label < 5"), path, fx.SETTINGS)
    embeddings.write_embeddings(rows, path, fx.SETTINGS)
    return _store_columns(embeddings.read_store(spark, path))


@query(
    "read_embeddings",
    f"""WITH {q.STORE}, wanted AS (SELECT DISTINCT id, class_label FROM features)
    SELECT w.id, w.class_label, s.chunk_index, s.species_name AS stored_species_name, CAST(len(s.embedding) AS INTEGER) AS width
    FROM wanted w JOIN store s ON s.audio_id = CAST(w.id AS VARCHAR)""",
)
def _(spark, sf_dir):
    wanted = fx.features(spark, sf_dir).select("id", "class_label").distinct()
    rows = embeddings.read_embeddings(wanted, fx.embedding_store(spark, sf_dir), fx.SETTINGS)
    return rows.withColumn("width", F.size("features")).drop("features")


@query("split_ids_roundtrip", f"WITH {q.SPLITS} SELECT id, split FROM split_ids WHERE split = 'test'")
def _(spark, sf_dir):
    return artifacts.split_ids_roundtrip(fx.split_ids(spark, sf_dir), scratch_dir(spark, "split-ids"), "test")


@query(
    "read_eval_artifacts",
    f"""WITH {q.ERRORS}, {q.SPLITS} SELECT id, pred_class, ({q.M})[pred_class + 1] AS predicted_species
    FROM errs WHERE id IN (SELECT id FROM split_ids WHERE split = 'test')""",
)
def _(spark, sf_dir):
    path, rows = scratch_dir(spark, "evaluation"), fx.errors(spark, sf_dir)
    mapping = spark.createDataFrame(list(enumerate(fx.MAPPING.species)), "class_label int, species_name string")
    rows.write.parquet(f"{path}/predictions")
    mapping.write.parquet(f"{path}/class_mapping")
    tested = fx.split_ids(spark, sf_dir).filter("split = 'test'").select("id")
    tested.write.parquet(f"{path}/test_ids")
    found = artifacts.read_eval_artifacts(spark, path)
    names = found["class_mapping"].select(F.col("class_label").alias("pred_class"), F.col("species_name").alias("predicted_species"))
    tested = found["predictions"].join(found["test_ids"], "id", "left_semi")
    return tested.join(names, "pred_class", "left").select("id", "pred_class", "predicted_species")


@query(
    "incremental_features",
    f"""WITH {q.FEATURES} SELECT id, chunk_index, class_label, species_name,
    CASE WHEN is_held THEN 'hit' ELSE 'to_do' END AS status,
    (SELECT count(*) FROM features) AS n_wanted, (SELECT count(*) FROM features WHERE is_held) AS n_hits,
    (SELECT count(*) FROM features WHERE NOT is_held) AS n_to_do FROM features""",
)
def _(spark, sf_dir):
    rows = fx.features(spark, sf_dir)
    held = rows.filter("is_held").select("id", "chunk_index", "features")
    hits, to_do, counts = embeddings.incremental_features(rows.drop("features", "vec_id"), held)
    both = hits.drop("features").withColumn("status", F.lit("hit")).unionByName(to_do.withColumn("status", F.lit("to_do")))
    n_wanted, n_hits, n_to_do = counts.first()
    numbers = [F.lit(n).cast("bigint").alias(name) for n, name in ((n_wanted, "n_wanted"), (n_hits, "n_hits"), (n_to_do, "n_to_do"))]
    return both.select("id", "chunk_index", "class_label", "species_name", "status", *numbers)


@query("scan_audio_inventory", "SELECT s_suppkey AS id FROM supplier WHERE s_acctbal >= 0 AND s_nationkey > 3")
def _(spark, sf_dir):
    """One small audio file per supplier is written by the tasks, some under names that do not count."""
    folder = scratch_dir(spark, "audio")

    def write_files(batches):
        from pyarrow import fs

        for batch in batches:
            for name in batch["name"]:
                system, path = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                system.create_dir(path)
                with system.open_output_stream(f"{path}/{name}") as out:
                    out.write(b"RIFF")
            yield batch.assign(written=1)[["written"]]

    key = F.col("s_suppkey")
    stem = F.when(F.col("s_acctbal") < 0, F.concat(F.lit("rec_"), key.cast("string"))).otherwise(key.cast("string"))
    extension = F.when(F.col("s_nationkey") <= 3, ".txt").otherwise(".wav")
    names = fx.table(spark, sf_dir, "supplier").select(F.concat(stem, extension).alias("name"))
    names.mapInPandas(write_files, "written int").count()
    return artifacts.scan_audio_inventory(spark, folder, "wav")


@query(
    "retain_features",
    f"""WITH {q.FEATURES} SELECT id, chunk_index, CASE WHEN is_held THEN 'npz' ELSE 'pkl' END AS format,
    CASE WHEN class_label < 5 AND is_held THEN 'kept' ELSE 'removed' END AS status FROM features""",
)
def _(spark, sf_dir):
    kind = F.when(F.col("is_held"), "npz").otherwise("pkl")
    rows = fx.features(spark, sf_dir).withColumn("format", kind)
    # Stored, rewritten without the unwanted rows, and read back.
    root, by = scratch_dir(spark, "retained"), ["class_label"]
    versions.create_versions(rows, root, by)
    _, removed = versions.rewrite_retained(spark, root, by, rows.filter("class_label < 5").select("id"), ["npz"])
    kept = versions.read_version(spark, root).select(*removed.columns)
    both = kept.withColumn("status", F.lit("kept")).unionByName(removed.withColumn("status", F.lit("removed")))
    return both.select("id", "chunk_index", "format", "status")


@query("batch_score_table", f"WITH {q.CHUNKS} SELECT vec_id, pred AS y_pred, {q.decimals('probs')} AS probs FROM voted")
def _(spark, sf_dir):
    source, target = scratch_dir(spark, "chunks"), scratch_dir(spark, "scores")
    write_table(fx.chunks(spark, sf_dir), source)

    def scorer(df):
        return fx.chunk_scorer(df).select("vec_id", argmax(F.col("probs")).alias("y_pred"), "probs")

    return artifacts.batch_score_table(spark, source, target, scorer)


@query(
    "feature_table_range",
    """SELECT user_id, event_id, ts, round(value, 6) AS value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
      WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20') WHERE rn = 1""",
)
def _(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    latest = artifacts.feature_table_range(events, "ts", "2024-01-05", "2024-01-20", ["user_id"], "event_id")
    return latest.select("user_id", "event_id", "ts", "value")


# --- filters ---------------------------------------------------------------------------


def _filter_query(name, fn, condition, cols):
    @query(name, f"WITH {q.RAW} SELECT id, {cols} FROM raw WHERE {condition}")
    def _(spark, sf_dir):
        return fx.parsed(spark, sf_dir).transform(fn).select("id", cols)


_filter_query("filter_published", clean.filter_published, q.PUBLISHED, "validated_status")
_filter_query("filter_has_audio", clean.filter_has_audio, q.HAS_AUDIO, "call_audio")
_filter_query("filter_labelled", clean.filter_labelled, q.LABELLED, "state")
_filter_query("filter_not_duplicate", clean.filter_not_duplicate, q.NOT_DUP, "is_duplicate")
_filter_query("filter_appropriate", clean.filter_appropriate, q.APPROPRIATE, "inappropriate_content")
_filter_query("filter_no_people", clean.filter_no_people, q.NO_PEOPLE, "has_people_activity")
_filter_query("filter_quality", clean.filter_quality, q.QUALITY, "quality_call")


@query("clean_recordings", f"WITH {q.KEPT} SELECT id, state, capture_time FROM kept")
def _(spark, sf_dir):
    return _kept(spark, sf_dir).select("id", "state", "capture_time")


def _funnel_sql() -> str:
    parts = []
    for order, steps in (("selector", q.STEPS), ("dashboard", [q.STEPS[2], q.STEPS[0], q.STEPS[1], *q.STEPS[3:]])):
        conditions, names = ["TRUE"], ["raw"]
        for name, cond in steps:
            conditions.append(f"{conditions[-1]} AND {cond}")
            names.append(name)
        for i, (name, cond) in enumerate(zip(names, conditions)):
            n = f"count(*) FILTER (WHERE {cond})"
            parts.append(
                f"SELECT '{order}' AS step_order, CAST({i + 1} AS INTEGER) AS step_number, '{name}' AS step, "
                f"{n} AS count, {q.pct(n, 'count(*)')} AS percentage FROM raw"
            )
    return f"WITH {q.RAW} " + " UNION ALL ".join(parts)


@query("filter_funnel", _funnel_sql())
def _(spark, sf_dir):
    rows = fx.parsed(spark, sf_dir)
    both = [clean.filter_funnel(rows, order=o).withColumn("step_order", F.lit(o)) for o in ("selector", "dashboard")]
    return both[0].unionByName(both[1])


@query("project_cleaned", f"WITH {q.cleaned('first')} {q.CLEANED_SHOWN}")
def _(spark, sf_dir):
    return clean.project_cleaned(derive.derive_columns(_kept(spark, sf_dir), fx.MAPPING, "first"))


def _strategy_query(name, fn, condition, ctes="", anchor="first-target"):
    @query(name, f"WITH {q.cleaned(anchor)} {ctes} SELECT id, species_count, class_label_single FROM cleaned WHERE {condition}")
    def _(spark, sf_dir):
        return fx.cleaned(spark, sf_dir, anchor).transform(fn).select("id", "species_count", "class_label_single")


_strategy_query(
    "apply_strategy",
    lambda df: strategies.apply_strategy(strategies.apply_strategy(df, "multi-species-only"), lambda d: d.filter("species_count > 2")),
    "is_multi_species AND species_count > 2",
)
_strategy_query("single_species_only", strategies.single_species_only, "NOT is_multi_species")
_strategy_query("multi_species_only", strategies.multi_species_only, "is_multi_species")
_strategy_query("other_species_only", strategies.other_species_only, "NOT includes_target_species")
_strategy_query(
    "rare_species_only",
    lambda df: strategies.rare_species_only(df, RARE_BELOW),
    "list_has_any(species_names, (SELECT list(s) FROM rare))",
    f""", rare AS (SELECT s FROM (SELECT unnest(species_names) AS s FROM cleaned) GROUP BY s HAVING count(*) < {RARE_BELOW})""",
)


def _top3(n: int) -> str:
    return f"""is_multi_species AND species_count = {n} AND includes_target_species AND class_label_single IN (
      SELECT class_label_single FROM cleaned
      WHERE is_multi_species AND species_count = {n} AND includes_target_species AND class_label_single IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)"""


_strategy_query("multi_2_top3_targets", strategies.multi_2_top3_targets, _top3(2))
_strategy_query("multi_3_top3_targets", strategies.multi_3_top3_targets, _top3(3))


# --- derived columns -------------------------------------------------------------------


@query(
    "parse_capture_time",
    f"""WITH {q.RAW} SELECT id, CASE WHEN id % 4 = 2 THEN NULL ELSE capture_time END AS capture_time FROM raw""",
)
def _(spark, sf_dir):
    """The times are written out in four forms, one of them no time at all, and read back."""
    t, form = F.col("capture_time"), F.col("id") % 4
    text = (
        F.when(form == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
        .when(form == 1, F.date_format(t, "M/d/yyyy H:mm"))
        .when(form == 2, F.lit("not a time"))
        .otherwise(F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+10:00")))
    )
    rows = fx.recordings_raw(spark, sf_dir).select("id", text.alias("capture_time"))
    return derive.parse_capture_time(rows)


def _kept_query(name, columns, fn, source=_kept):
    """A query over kept rows whose check lists the same columns."""
    names = [part.rsplit(" AS ", 1)[-1].strip() for part in columns]

    @query(name, f"WITH {q.KEPT} SELECT {', '.join(columns)} FROM kept")
    def _(spark, sf_dir):
        return fn(source(spark, sf_dir)).select(*names)


_kept_query(
    "sort_species",
    ["id", f"{q.joined('list_sort(names)')} AS validated_frog_names", f"{q.joined('list_sort(ids)')} AS validated_frog_ids"],
    derive.sort_species,
)
_kept_query(
    "temporal_features",
    ["id", "CAST(year(capture_time) AS INTEGER) AS year", "CAST(month(capture_time) AS INTEGER) AS month",
     "CAST(hour(capture_time) AS INTEGER) AS hour"],
    derive.temporal_features,
)
_kept_query(
    "species_count_features",
    ["id", "len(ids) > 1 AS is_multi_species", "CAST(len(ids) AS INTEGER) AS species_count"],
    derive.species_count_features,
)
_kept_query(
    "includes_target",
    ["id", f"list_has_any(names, {q.T}) AS includes_target_species"],
    lambda df: derive.includes_target(df, fx.TARGETS),
)
_IN_M = f"CAST({q.TARGET_COUNT} AS INTEGER)"
_kept_query(
    "target_species_count",
    ["id", f"{_IN_M} AS target_species_count"],
    lambda df: derive.target_species_count(df, fx.MAPPING.species),
)


def _counted(df):
    return derive.target_species_count(derive.species_count_features(df), fx.MAPPING.species)


_kept_query(
    "target_species_ratio",
    ["id", f"round(CAST({_IN_M} AS DOUBLE) / len(ids), 6) AS target_species_ratio"],
    lambda df: derive.target_species_ratio(_counted(df)),
)
_kept_query(
    "species_type",
    ["id", f"CASE WHEN {_IN_M} = 0 THEN 'Other' WHEN {_IN_M} = len(ids) THEN 'Target Only' ELSE 'Mixed' END AS species_type"],
    lambda df: derive.species_type(_counted(df)),
)
_kept_query(
    "class_labels",
    ["id", f"{q.joined(f'list_transform({q.ON_TARGET}, lambda n: list_position({q.M}, n) - 1)')} AS class_labels"],
    lambda df: derive.class_labels(df, fx.MAPPING),
    _named,
)
_kept_query(
    "multi_hot_vector",
    ["id", f"{q.joined(f'list_transform({q.M}, lambda t: CASE WHEN list_contains(names, t) THEN 1 ELSE 0 END)')} AS class_label_vector"],
    lambda df: derive.multi_hot_vector(df, fx.MAPPING.species),
    _named,
)
_kept_query(
    "first_species",
    ["id", "names[1] AS first_species_name", "ids[1] AS first_species_id"],
    derive.first_species,
)


@query("species_frequency", f"WITH {q.KEPT}, {q.FREQ} SELECT s AS species, n AS count FROM freq")
def _(spark, sf_dir):
    return an.species_frequency(_named(spark, sf_dir))


def _anchor_query(name, anchor):
    @query(name, f"WITH {q.with_anchor(anchor)} SELECT id, anchor AS anchor_species FROM anchored")
    def _(spark, sf_dir):
        return an.ANCHORS[anchor](_named(spark, sf_dir), fx.MAPPING.species).select("id", "anchor_species")


_anchor_query("anchor_first", "first")
_anchor_query("anchor_first_target", "first-target")
_anchor_query("anchor_most_frequent", "most-frequent")
_anchor_query("anchor_most_frequent_target", "most-frequent-target")


@query(
    "single_label",
    f"""WITH {q.cleaned('most-frequent')}
    SELECT id, species_name_single, class_label_single, class_name_single FROM cleaned""",
)
def _(spark, sf_dir):
    labelled = derive.single_label(_named(spark, sf_dir), fx.MAPPING, "most-frequent")
    return labelled.select("id", "species_name_single", "class_label_single", "class_name_single")


@query("class_name", f"WITH {q.CHUNKS} SELECT vec_id, y_true, ({q.M})[y_true + 1] AS true_species FROM chunks")
def _(spark, sf_dir):
    rows = derive.class_name(fx.chunks(spark, sf_dir), fx.MAPPING, "y_true", "true_species")
    return rows.select("vec_id", "y_true", "true_species")


@query(
    "label_binarize",
    f"""WITH {q.CHUNKS} SELECT vec_id,
    {q.joined('list_transform(range(10), lambda c: CASE WHEN c = y_true THEN 1 ELSE 0 END)')} AS y_true_binarized FROM chunks""",
)
def _(spark, sf_dir):
    return derive.label_binarize(fx.chunks(spark, sf_dir), range(fx.N_CLASSES)).select("vec_id", "y_true_binarized")


@query(
    "percentage",
    f"""WITH {q.REPORT} SELECT state, {q.pct('count(*) FILTER (WHERE is_multi_species)', 'count(*)', 1)} AS percent_multi
    FROM report GROUP BY state""",
)
def _(spark, sf_dir):
    counts = fx.report_frame(spark, sf_dir).groupBy("state").agg(
        F.count_if("is_multi_species").alias("m"), F.count(F.lit(1)).alias("n")
    )
    return counts.select("state", percent(F.col("m"), F.col("n")).alias("percent_multi"))


@query("cleaned_recordings", f"WITH {q.cleaned()} {q.CLEANED_SHOWN}")
def _(spark, sf_dir):
    return fx.cleaned(spark, sf_dir)


@query(
    "dashboard_frame",
    f"""WITH {q.REPORT} SELECT id, first_species_name, first_species_id, {q.joined('sorted_species_names')} AS sorted_species_names,
    {q.joined('sorted_species_ids')} AS sorted_species_ids, includes_target_species, species_count, is_multi_species, state,
    capture_time FROM report""",
)
def _(spark, sf_dir):
    return fx.report_frame(spark, sf_dir)
