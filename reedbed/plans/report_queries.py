"""Queries over joins, distributions and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reedbed.functions.columns import species_of
from reedbed.operators import joins, reports
from reedbed.plans import fixtures as fx
from reedbed.plans import sql as q
from reedbed.plans.registry import query
from reedbed.sources import embeddings

ID_STATE = ["id", "state"]


# --- joins -----------------------------------------------------------------------------


@query(
    "modelling_subset",
    f"WITH {q.cleaned()}, {q.SPLITS} SELECT id, state FROM cleaned WHERE id IN (SELECT id FROM split_ids WHERE split = 'train')",
)
def _(spark, sf_dir):
    return joins.modelling_subset(fx.cleaned(spark, sf_dir), fx.split_ids(spark, sf_dir), "train").select(*ID_STATE)


@query("holdout_pool", f"WITH {q.cleaned()}, {q.SPLITS} SELECT id, state FROM cleaned WHERE id NOT IN (SELECT id FROM split_ids)")
def _(spark, sf_dir):
    return joins.holdout_pool(fx.cleaned(spark, sf_dir), fx.split_ids(spark, sf_dir)).select(*ID_STATE)


@query(
    "reconcile_audio",
    f"""WITH {q.cleaned()}, {q.INVENTORY} SELECT id,
    CASE WHEN id IN (SELECT id FROM inventory) THEN 'available' ELSE 'missing' END AS status FROM cleaned""",
)
def _(spark, sf_dir):
    found, missing = joins.reconcile_audio(fx.cleaned(spark, sf_dir), fx.inventory(spark, sf_dir))
    return found.select("id", F.lit("available").alias("status")).union(missing.select("id", F.lit("missing").alias("status")))


@query("drop_missing_audio", f"WITH {q.cleaned()}, {q.INVENTORY} SELECT id, state FROM cleaned WHERE id NOT IN (SELECT id FROM failed)")
def _(spark, sf_dir):
    return joins.drop_missing_audio(fx.cleaned(spark, sf_dir), fx.failed_ids(spark, sf_dir)).select(*ID_STATE)


@query(
    "embedding_coverage",
    f"""WITH {q.STORE} SELECT id, chunk_index,
    CASE WHEN CAST(id AS VARCHAR) IN (SELECT audio_id FROM store WHERE species_name < 'sp5') THEN 'stored' ELSE 'to_do' END AS status
    FROM features""",
)
def _(spark, sf_dir):
    held = fx.embedding_store(spark, sf_dir).filter("species_name < 'sp5'")
    stored, to_do = embeddings.embedding_coverage(fx.features(spark, sf_dir), held, fx.SETTINGS)
    keys = ["id", "chunk_index"]
    return stored.select(*keys, F.lit("stored").alias("status")).union(to_do.select(*keys, F.lit("to_do").alias("status")))


@query("unused_pool", f"WITH {q.cleaned()}, {q.INVENTORY} SELECT id, state FROM cleaned WHERE id NOT IN (SELECT id FROM inventory)")
def _(spark, sf_dir):
    return joins.unused_pool(fx.cleaned(spark, sf_dir), fx.inventory(spark, sf_dir)).select(*ID_STATE)


@query(
    "download_summary",
    f"""WITH {q.cleaned()}, {q.INVENTORY}, r AS (
      SELECT id, id IN (SELECT id FROM inventory) AS have, id IN (SELECT id FROM failed) AS lost FROM cleaned), c AS (
      SELECT count(*) AS required_count, count(*) FILTER (WHERE have) AS available_count,
        count(*) FILTER (WHERE NOT have) AS missing_from_directory_count,
        count(*) FILTER (WHERE NOT have AND NOT lost) AS downloaded_count,
        count(*) FILTER (WHERE NOT have AND lost) AS failed_to_download_count,
        count(*) FILTER (WHERE NOT have AND lost) AS missing_after_download_count FROM r)
    SELECT *, required_count - missing_after_download_count AS ready_for_use_count,
      missing_after_download_count = 0 AS has_complete_data FROM c""",
)
def _(spark, sf_dir):
    return joins.download_summary(fx.cleaned(spark, sf_dir), fx.inventory(spark, sf_dir), fx.failed_ids(spark, sf_dir))


# --- grouped distributions -------------------------------------------------------------

_GROUPS = """
groups AS (
  SELECT class_label_single, class_name_single,
    count(*) FILTER (WHERE NOT is_multi_species) AS single_species, count(*) FILTER (WHERE is_multi_species) AS multi_species,
    count(*) AS total FROM cleaned GROUP BY 1, 2),
uniq AS (SELECT class_label_single, count(DISTINCT s) AS unique_species
  FROM (SELECT class_label_single, unnest(species_names) AS s FROM cleaned) GROUP BY 1),
dist AS (SELECT g.*, u.unique_species FROM groups g JOIN uniq u ON u.class_label_single = g.class_label_single)"""
BY = ["class_label_single", "class_name_single"]


@query(
    "grouped_distribution",
    f"WITH {q.cleaned('most-frequent')}, {_GROUPS} SELECT * FROM dist",
)
def _(spark, sf_dir):
    return reports.grouped_distribution(fx.cleaned(spark, sf_dir, "most-frequent"), BY)


@query(
    "grouped_distribution_total",
    f"""WITH {q.cleaned('most-frequent')}, {_GROUPS}
    SELECT class_label_single, class_name_single, FALSE AS is_total, unique_species, CAST(single_species AS BIGINT) AS single_species,
      CAST(multi_species AS BIGINT) AS multi_species, CAST(total AS BIGINT) AS total FROM dist
    UNION ALL SELECT NULL, NULL, TRUE, (SELECT count(DISTINCT s) FROM (SELECT unnest(species_names) AS s FROM cleaned)),
      CAST(sum(single_species) AS BIGINT), CAST(sum(multi_species) AS BIGINT), CAST(sum(total) AS BIGINT) FROM dist""",
)
def _(spark, sf_dir):
    return reports.grouped_distribution_total(fx.cleaned(spark, sf_dir, "most-frequent"), BY)


# --- report frame ----------------------------------------------------------------------

_OCC = """
occ AS (SELECT species, count(*) AS count FROM (SELECT unnest(sorted_species_names) AS species FROM report) GROUP BY 1)"""
_OCC_PCT = q.pct("count", "(SELECT sum(count) FROM occ)")
_BY_STATE = f"""
by_state AS (
  SELECT species, state, count(*) AS count FROM (SELECT DISTINCT id, state, unnest(sorted_species_names) AS species FROM report)
  WHERE list_contains({q.T}, species) AND state IS NOT NULL GROUP BY 1, 2)"""
_BY_YEAR = f"""
by_year AS (
  SELECT species, CAST(year(capture_time) AS INTEGER) AS year, count(*) AS count
  FROM (SELECT DISTINCT id, capture_time, unnest(sorted_species_names) AS species FROM report)
  WHERE list_contains({q.T}, species) AND capture_time IS NOT NULL GROUP BY 1, 2)"""


def _report_query(name, sql, fn):
    @query(name, f"WITH {q.REPORT}{sql}")
    def _(spark, sf_dir):
        return fn(fx.report_frame(spark, sf_dir))


_report_query(
    "occurrence_distribution",
    f", {_OCC} SELECT species, count, {_OCC_PCT} AS percentage FROM occ",
    reports.occurrence_distribution,
)
_report_query(
    "target_occurrence_distribution",
    f", {_OCC} SELECT species, count, {_OCC_PCT} AS percentage FROM occ WHERE list_contains({q.T}, species)",
    lambda df: reports.target_occurrence_distribution(df, fx.TARGETS),
)
_report_query(
    "target_by_state", f", {_BY_STATE} SELECT * FROM by_state", lambda df: reports.target_by_state(df, fx.TARGETS)
)
_report_query(
    "order_by_total",
    f", {_BY_STATE} SELECT state, CAST(sum(count) AS BIGINT) AS total FROM by_state GROUP BY 1",
    lambda df: reports.order_by_total(reports.target_by_state(df, fx.TARGETS), "state"),
)
_report_query("target_by_year", f", {_BY_YEAR} SELECT * FROM by_year", lambda df: reports.target_by_year(df, fx.TARGETS))
_report_query(
    "top_species_by_total",
    f", {_BY_YEAR} SELECT species, CAST(sum(count) AS BIGINT) AS total FROM by_year GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
    lambda df: reports.top_species_by_total(reports.target_by_year(df, fx.TARGETS)),
)


def _share_sql(value: str, cols: str) -> str:
    return f""", g AS (SELECT CAST({value} AS INTEGER) AS v, count(*) AS count FROM report GROUP BY 1)
    SELECT {cols}, count, {q.pct('count', '(SELECT sum(count) FROM g)')} AS percentage FROM g WHERE v IS NOT NULL"""


_report_query("records_by_year", _share_sql("year(capture_time)", "v AS year"), reports.records_by_year)
_report_query(
    "records_by_month",
    _share_sql("month(capture_time)", f"v AS month_number, ({q.sql_list(reports.MONTH_NAMES)})[v] AS month"),
    reports.records_by_month,
)
_report_query("records_by_hour", _share_sql("hour(capture_time)", "v AS hour"), reports.records_by_hour)
_report_query(
    "species_per_recording", _share_sql("species_count", "v AS species_count"), reports.species_per_recording
)


def _first_sql(cond: str) -> str:
    return f""", g AS (SELECT first_species_name AS species, count(*) AS count FROM report WHERE {cond} GROUP BY 1)"""


_report_query(
    "single_target_distribution",
    _first_sql("includes_target_species AND NOT is_multi_species")
    + " SELECT species, count, round(CAST(count AS DOUBLE) / (SELECT sum(count) FROM g) * 100, 6) AS percentage FROM g",
    reports.single_target_distribution,
)
_report_query(
    "single_other_distribution",
    _first_sql("NOT includes_target_species AND NOT is_multi_species") + " SELECT * FROM g",
    reports.single_other_distribution,
)
_report_query(
    "multi_target_distribution",
    f""", m AS (SELECT * FROM report WHERE includes_target_species AND is_multi_species),
    g AS (SELECT species, count(*) AS count FROM (SELECT unnest(sorted_species_names) AS species FROM m)
          WHERE list_contains({q.T}, species) GROUP BY 1)
    SELECT species, count, round(CAST(count AS DOUBLE) / (SELECT count(*) FROM m) * 100, 6) AS percentage FROM g""",
    lambda df: reports.multi_target_distribution(df, fx.TARGETS),
)
_report_query(
    "multi_other_distribution",
    """ SELECT species, count(*) AS count FROM (SELECT unnest(sorted_species_names) AS species FROM report
    WHERE NOT includes_target_species AND is_multi_species) GROUP BY 1""",
    lambda df: reports.multi_other_distribution(df, fx.TARGETS),
)
_report_query(
    "mean_species_count",
    " SELECT round_even(avg(species_count), 2) AS mean_species_count FROM report",
    reports.mean_species_count,
)

_PAIRS = f""", p0 AS (
  SELECT id, sorted_species_names[1] AS species_1, sorted_species_names[2] AS species_2,
    list_sort(list_filter(sorted_species_names, lambda n: list_contains({q.T}, n))) AS found FROM report WHERE species_count = 2),
pairs AS (
  SELECT id, species_1, species_2, {q.joined('found')} AS target_species, CAST(len(found) AS INTEGER) AS target_count,
    len(found) > 0 AS has_target,
    CASE len(found) WHEN 2 THEN 'target_target' WHEN 1 THEN 'target_other' ELSE 'other_other' END AS combination_type FROM p0)"""
_report_query(
    "species_pairs", _PAIRS + " SELECT * FROM pairs", lambda df: reports.species_pairs(df, fx.TARGETS)
)
_report_query(
    "pair_type_distribution",
    _PAIRS
    + f""" SELECT combination_type, count(*) AS count, {q.pct('count(*)', '(SELECT count(*) FROM pairs)')} AS percentage
    FROM pairs GROUP BY 1""",
    lambda df: reports.pair_type_distribution(df, fx.TARGETS),
)


def _summary_sql() -> str:
    def n(cond: str) -> str:
        return f"(SELECT count(*) FROM report WHERE {cond})"

    def species(cond: str) -> str:
        return f"(SELECT count(DISTINCT s) FROM (SELECT unnest(sorted_species_names) AS s FROM report WHERE {cond}))"

    single, multi, target = "NOT is_multi_species", "is_multi_species", "includes_target_species"
    raw_n, total = "(SELECT count(*) FROM raw)", n("TRUE")
    occ = "(SELECT CAST(sum(len(sorted_species_names)) AS BIGINT) FROM report)"
    occ_t = f"(SELECT CAST(sum(len(list_filter(sorted_species_names, lambda x: list_contains({q.T}, x)))) AS BIGINT) FROM report)"
    cols = {
        "raw_count_total": raw_n,
        "raw_num_species": "(SELECT count(DISTINCT s) FROM (SELECT unnest(names) AS s FROM raw))",
        "filtered_count_total": total,
        "filtered_percent_of_raw": q.pct(total, raw_n),
        "filtered_num_species": species("TRUE"),
        "filtered_count_species_occurrences": occ,
        "filtered_count_target_occurrences": occ_t,
        "filtered_percent_target_occurrences": q.pct(occ_t, occ),
    }
    for name, cond in (("single", single), ("multi", multi)):
        part, t, o = n(cond), n(f"{cond} AND {target}"), n(f"{cond} AND NOT {target}")
        cols |= {
            f"{name}_count_total": part,
            f"{name}_count_target": t,
            f"{name}_count_other": o,
            f"{name}_percent_of_total": q.pct(part, total),
            f"{name}_percent_target_of_total": q.pct(t, total),
            f"{name}_percent_other_of_total": q.pct(o, total),
            f"{name}_percent_target_of_{name}": q.pct(t, part),
            f"{name}_percent_other_of_{name}": q.pct(o, part),
            f"{name}_num_species": species(cond),
            f"{name}_num_target_species": species(f"{cond} AND {target}"),
            f"{name}_num_other_species": species(f"{cond} AND NOT {target}"),
        }
    return f"WITH {q.REPORT} SELECT " + ", ".join(f"{v} AS {k}" for k, v in cols.items())


@query("dataset_summary", _summary_sql())
def _(spark, sf_dir):
    return reports.dataset_summary(fx.parsed(spark, sf_dir), fx.TARGETS)


@query(
    "class_support",
    f"WITH {q.cleaned('first')} SELECT count(*) AS num_samples, count(DISTINCT class_label_single) AS num_labels FROM cleaned",
)
def _(spark, sf_dir):
    return reports.class_support(fx.cleaned(spark, sf_dir, "first"))


@query(
    "species_top_n",
    f"""WITH {q.TEST_IDS} SELECT species_name, count(*) AS count FROM test_ids WHERE species_name IS NOT NULL
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(spark, sf_dir):
    return reports.species_top_n(fx.test_ids(spark, sf_dir), 10)


_OTHERS = """, others AS (SELECT species_name, count(*) AS count FROM test_ids WHERE label = 0 AND species_name IS NOT NULL GROUP BY 1)"""


@query("other_value_counts", f"WITH {q.TEST_IDS} {_OTHERS} SELECT * FROM others")
def _(spark, sf_dir):
    return reports.other_value_counts(fx.test_ids(spark, sf_dir), 0)


@query(
    "other_concentration",
    f"""WITH {q.TEST_IDS} {_OTHERS}, top5 AS (SELECT count FROM others ORDER BY count DESC, species_name LIMIT 5)
    SELECT count(*) AS unique_species, count(*) FILTER (WHERE count = 1) AS singletons, count(*) FILTER (WHERE count < 5) AS few_samples,
      {q.pct('count(*) FILTER (WHERE count < 5)', 'count(*)', 1)} AS percent_few,
      (SELECT CAST(sum(count) AS BIGINT) FROM top5) AS top_5_sum, CAST(sum(count) AS BIGINT) AS total,
      {q.pct('(SELECT sum(count) FROM top5)', 'sum(count)', 1)} AS percent_top_5 FROM others""",
)
def _(spark, sf_dir):
    return reports.other_concentration(fx.test_ids(spark, sf_dir), 0)


@query(
    "describe_by_species",
    f"""WITH {q.TEST_IDS} SELECT species_name, count(*) AS count, round(avg(duration_seconds), 6) AS mean,
    round(stddev_samp(duration_seconds), 6) AS std, min(duration_seconds) AS min,
    round(quantile_cont(duration_seconds, 0.25), 6) AS p25, round(quantile_cont(duration_seconds, 0.5), 6) AS p50,
    round(quantile_cont(duration_seconds, 0.75), 6) AS p75, max(duration_seconds) AS max
    FROM test_ids WHERE species_name IS NOT NULL GROUP BY 1""",
)
def _(spark, sf_dir):
    return reports.describe_by_species(fx.test_ids(spark, sf_dir), "duration_seconds")


# --- error analysis --------------------------------------------------------------------


def _name_of(label):
    return species_of(label, fx.MAPPING.species)


def _error_query(name, sql, fn):
    @query(name, f"WITH {q.ERRORS} {sql}")
    def _(spark, sf_dir):
        return fn(fx.errors(spark, sf_dir))


_error_query(
    "other_accuracy",
    """SELECT count(*) AS other_total, count(*) FILTER (WHERE is_correct) AS other_correct,
    round(CAST(count(*) FILTER (WHERE is_correct) AS DOUBLE) / count(*), 6) AS other_accuracy FROM errs WHERE actual_class = 0""",
    lambda df: reports.other_accuracy(df, 0),
)
_error_query(
    "error_type_breakdown",
    """SELECT error_type, count(*) AS count, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM errs WHERE actual_class = 0), 6)
    AS proportion FROM errs WHERE actual_class = 0 GROUP BY 1""",
    lambda df: reports.error_type_breakdown(df, 0),
)
_error_query(
    "per_species_accuracy",
    """SELECT validated_frog_names, count(*) AS count, round(avg(CASE WHEN is_correct THEN 1.0 ELSE 0.0 END), 6) AS accuracy
    FROM errs WHERE actual_class = 0 GROUP BY 1""",
    lambda df: reports.per_species_accuracy(df, 0),
)
_error_query(
    "other_as_target_confusion",
    f""", g AS (SELECT validated_frog_names, pred_class, count(*) AS cases, round(avg(pred_class_prob), 6) AS mean_confidence
      FROM errs WHERE actual_class = 0 AND pred_class <> 0 GROUP BY 1, 2),
    t AS (SELECT *, CAST(sum(cases) OVER (PARTITION BY validated_frog_names) AS BIGINT) AS total_cases FROM g)
    SELECT *, ({q.M})[pred_class + 1] AS confused_target, round(CAST(cases AS DOUBLE) / total_cases, 6) AS confusion_rate,
      cases || ' / ' || total_cases AS rate_cases FROM t""",
    lambda df: reports.other_as_target_confusion(df, 0, _name_of),
)
_error_query(
    "target_as_other_confusion",
    f""", g AS (SELECT actual_class, count(*) FILTER (WHERE pred_class = 0) AS cases,
      round(avg(pred_class_prob) FILTER (WHERE pred_class = 0), 6) AS mean_confidence, count(*) AS total_cases
      FROM errs WHERE actual_class <> 0 GROUP BY 1)
    SELECT *, ({q.M})[actual_class + 1] AS target_species, round(CAST(cases AS DOUBLE) / total_cases, 6) AS confusion_rate,
      cases || ' / ' || total_cases AS rate_cases FROM g WHERE cases > 0""",
    lambda df: reports.target_as_other_confusion(df, 0, _name_of),
)
