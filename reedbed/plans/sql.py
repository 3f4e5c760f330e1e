"""The derived inputs again in DuckDB SQL, for the checks."""

from __future__ import annotations

from reedbed.plans.fixtures import MAPPING, TARGETS


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


T = sql_list(TARGETS)
M = sql_list(MAPPING.species)


def joined(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda x: CAST(x AS VARCHAR)), ',')"


def decimals(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda x: CAST(CAST(CAST(x AS DOUBLE) AS DECIMAL(18,6)) AS VARCHAR)), ',')"


def pct(num: str, den: str, digits: int = 0) -> str:
    return f"round_even(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0) * 100, {digits})"


def label_of(name: str) -> str:
    return f"CASE WHEN list_contains({M}, {name}) THEN CAST(list_position({M}, {name}) - 1 AS INTEGER) END"


RAW = """
sp AS (
  SELECT id, CASE WHEN id % 2 = 0 THEN every ELSE [every[id % len(every) + 1]] END AS names FROM (
  SELECT l.l_orderkey AS id, list_sort(list(DISTINCT p.p_brand)) AS every
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  GROUP BY 1)),
raw AS (
  SELECT o.o_orderkey AS id,
    CASE WHEN o.o_orderkey % 29 = 0 THEN NULL WHEN o.o_orderkey % 31 = 0 THEN '  '
         ELSE 'https://audio.example/' || o.o_orderkey || '.aac' END AS call_audio,
    CASE WHEN o.o_orderkey % 13 = 0 THEN FALSE WHEN o.o_orderkey % 3 = 1 THEN NULL ELSE TRUE END AS quality_call,
    n.n_name AS state,
    CASE WHEN o.o_orderkey % 37 <> 0 THEN o.o_orderdate + (o.o_orderkey % 24) * INTERVAL 1 HOUR END AS capture_time,
    '[' || array_to_string(list_transform(sp.names, lambda x: substr(x, 7)), ', ') || ']' AS validated_frog_ids,
    '[''' || array_to_string(sp.names, ''', ''') || ''']' AS validated_frog_names,
    CASE WHEN o.o_orderkey % 17 = 0 THEN TRUE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE FALSE END AS is_duplicate,
    CASE WHEN o.o_orderkey % 23 = 0 THEN TRUE ELSE NULL END AS inappropriate_content,
    o.o_orderkey % 19 = 0 AS has_people_activity,
    CASE WHEN o.o_orderstatus = 'P' THEN 'draft' ELSE 'published' END AS validated_status,
    sp.names AS names,
    list_transform(sp.names, lambda x: CAST(substr(x, 7) AS BIGINT)) AS ids
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN sp ON sp.id = o.o_orderkey AND CAST(floor(o.o_totalprice) AS BIGINT) % 4 <> 0)"""

PUBLISHED = "validated_status = 'published'"
HAS_AUDIO = "(call_audio IS NOT NULL AND trim(call_audio) <> '')"
LABELLED = "coalesce(len(names) > 0, FALSE)"
NOT_DUP = "is_duplicate IS DISTINCT FROM TRUE"
APPROPRIATE = "inappropriate_content IS DISTINCT FROM TRUE"
NO_PEOPLE = "has_people_activity IS DISTINCT FROM TRUE"
QUALITY = "quality_call IS DISTINCT FROM FALSE"
STEPS = [
    ("published", PUBLISHED), ("has_audio", HAS_AUDIO), ("labelled", LABELLED), ("not_duplicate", NOT_DUP),
    ("appropriate", APPROPRIATE), ("no_people", NO_PEOPLE), ("good_quality", QUALITY),
]

KEPT = RAW + f""",
kept AS (SELECT * FROM raw WHERE {' AND '.join(cond for _, cond in STEPS)})"""

TARGET_COUNT = f"len(list_filter(names, lambda n: list_contains({M}, n)))"

FREQ = """
freq AS (SELECT s, count(*) AS n FROM (SELECT unnest(names) AS s FROM kept) GROUP BY s)"""


def _picked(among: str) -> str:
    return f"""
picked AS (
  SELECT id, s AS anchor FROM (
    SELECT u.id, u.s, row_number() OVER (PARTITION BY u.id ORDER BY f.n DESC, u.s) AS rn
    FROM (SELECT id, unnest({among}) AS s FROM kept) u JOIN freq f ON f.s = u.s) WHERE rn = 1)"""


ON_TARGET = f"list_filter(names, lambda n: list_contains({M}, n))"


def with_anchor(anchor: str | None) -> str:
    """CTEs up to ``anchored``: kept rows with the anchor species."""
    if anchor in ("most-frequent", "most-frequent-target"):
        among = "names" if anchor == "most-frequent" else ON_TARGET
        return KEPT + "," + FREQ + "," + _picked(among) + """,
anchored AS (SELECT k.*, p.anchor FROM kept k LEFT JOIN picked p ON p.id = k.id)"""
    expr = {None: "CAST(NULL AS VARCHAR)", "first": "names[1]", "first-target": f"({ON_TARGET})[1]"}[anchor]
    return KEPT + f""",
anchored AS (SELECT *, {expr} AS anchor FROM kept)"""


def cleaned(anchor: str | None = None) -> str:
    """CTEs up to ``cleaned``: the registered columns, lists still as lists."""
    return with_anchor(anchor) + f""",
named AS (SELECT *, CASE WHEN len(names) = 1 THEN names[1] WHEN len(names) > 1 THEN anchor END AS chosen FROM anchored),
cleaned AS (
  SELECT id, state, call_audio, capture_time,
    CAST(year(capture_time) AS INTEGER) AS year, CAST(month(capture_time) AS INTEGER) AS month,
    CAST(hour(capture_time) AS INTEGER) AS hour,
    len(ids) > 1 AS is_multi_species, CAST(len(ids) AS INTEGER) AS species_count,
    list_has_any(names, {M}) AS includes_target_species,
    CAST({TARGET_COUNT} AS INTEGER) AS target_species_count,
    CASE WHEN len(ids) > 0 THEN CAST({TARGET_COUNT} AS DOUBLE) / len(ids) ELSE 0.0 END AS target_species_ratio,
    CASE WHEN {TARGET_COUNT} = 0 THEN 'Other' WHEN {TARGET_COUNT} = len(ids) THEN 'Target Only' ELSE 'Mixed' END AS species_type,
    names AS species_names, list_sort(ids) AS species_ids,
    list_transform({ON_TARGET}, lambda n: list_position({M}, n) - 1) AS class_labels,
    coalesce({label_of('chosen')}, 0) AS class_label_single,
    chosen AS species_name_single,
    ({M})[coalesce({label_of('chosen')}, 0) + 1] AS class_name_single,
    list_transform({M}, lambda t: CASE WHEN list_contains(names, t) THEN 1 ELSE 0 END) AS class_label_vector
  FROM named)"""


CLEANED_SHOWN = f"""SELECT id, state, call_audio, year, month, hour, is_multi_species, species_count,
  includes_target_species, target_species_count, round(target_species_ratio, 6) AS target_species_ratio, species_type,
  {joined('species_names')} AS species_names, {joined('species_ids')} AS species_ids,
  {joined('class_labels')} AS class_labels, class_label_single, species_name_single, class_name_single,
  {joined('class_label_vector')} AS class_label_vector FROM cleaned"""

REPORT = KEPT + f""",
report AS (
  SELECT id, names[1] AS first_species_name, ids[1] AS first_species_id,
    list_sort(names) AS sorted_species_names, list_sort(ids) AS sorted_species_ids,
    list_has_any(names, {T}) AS includes_target_species,
    CAST(len(ids) AS INTEGER) AS species_count, len(ids) > 1 AS is_multi_species, state, capture_time
  FROM kept)"""

_SCORE = " + ".join(f"coalesce(CAST(embedding[c + {10 * k + 1}] AS DOUBLE), 0.0)" for k in range(7))

CHUNKS = f"""
scored AS (
  SELECT vec_id, label, embedding, list_transform(range(0, 10), lambda c: exp(({_SCORE}) * 8)) AS e FROM embeddings),
chunks AS (
  SELECT (vec_id // 50) * 10 + label AS recording_id, CAST(vec_id % 50 AS INTEGER) AS chunk_index,
    label AS y_true, embedding, vec_id, list_transform(e, lambda x: x / list_sum(e)) AS probs FROM scored),
voted AS (SELECT *, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS pred, list_max(probs) AS conf FROM chunks)"""

FEATURES = CHUNKS + """,
features AS (
  SELECT recording_id AS id, chunk_index, embedding AS features, y_true AS class_label, 'sp' || y_true AS species_name, vec_id,
    embedding[1] > 0 AS is_held
  FROM chunks)"""

STORE = FEATURES + """,
store AS (SELECT CAST(id AS VARCHAR) AS audio_id, chunk_index, features AS embedding, species_name FROM features WHERE is_held)"""

# Rows of ``weighted``: recording, class, probability, weight of the chunk.
META = """
meta AS (SELECT recording_id, count(*) AS num_chunks, arg_min(y_true, chunk_index) AS y_true FROM voted GROUP BY 1)"""


def pooled(weight: str = "1.0", source: str = "voted") -> str:
    """CTEs up to ``rec``: weighted mean probabilities, argmax and confidence per recording."""
    return CHUNKS + "," + META + f""",
spread AS (SELECT recording_id, {weight} AS w, unnest(range(10)) AS c, unnest(probs) AS p FROM {source}),
means AS (SELECT recording_id, c, sum(w * p) / sum(w) AS p FROM spread GROUP BY 1, 2),
vecs AS (SELECT recording_id, list(p ORDER BY c) AS probs FROM means GROUP BY 1),
rec AS (
  SELECT v.recording_id, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS y_pred, list_max(probs) AS confidence,
    num_chunks, probs, y_true FROM vecs v JOIN meta m ON m.recording_id = v.recording_id)"""


REC_SHOWN = f"""SELECT recording_id, y_pred, round(confidence, 6) AS confidence, num_chunks,
  {decimals('probs')} AS probs, y_true FROM rec"""

ERRORS = CHUNKS + """,
errs0 AS (
  SELECT vec_id AS id, label AS actual_class, CAST(list_position(p, list_max(p)) - 1 AS BIGINT) AS pred_class, list_max(p) AS pred_class_prob,
    'sp' || vec_id % 7 AS validated_frog_names
  FROM (SELECT vec_id, label, list_transform(e, lambda x: x / list_sum(e)) AS p FROM scored)),
errs AS (
  SELECT *, pred_class = actual_class AS is_correct,
    CASE WHEN pred_class = actual_class THEN 'correct' WHEN actual_class = 0 THEN 'other_as_target'
         WHEN pred_class = 0 THEN 'target_as_other' ELSE 'target_swap' END AS error_type FROM errs0)"""

PREDS = """
preds AS (
  SELECT event_id, ts, 'm' || user_id % 3 AS model_id, value AS prediction, CAST(10 + event_id % 50 AS DOUBLE) AS label FROM events)"""

DAILY = PREDS + """,
daily AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, model_id, sqrt(avg((prediction - label) * (prediction - label))) AS rmse,
    count(*) AS num_predictions FROM preds GROUP BY 1, 2)"""

SPLITS = """
split_ids AS (
  SELECT o_orderkey AS id, CASE o_orderpriority WHEN '3-MEDIUM' THEN 'val' WHEN '4-NOT SPECIFIED' THEN 'test' ELSE 'train' END AS split
  FROM orders WHERE o_orderpriority <> '5-LOW')"""

INVENTORY = """
inventory AS (SELECT o_orderkey AS id FROM orders WHERE o_orderpriority <> '1-URGENT'),
failed AS (SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 250000)"""

TEST_IDS = cleaned("first") + """,
test_ids AS (
  SELECT id, class_label_single AS label, species_name_single AS species_name, o_totalprice AS duration_seconds
  FROM cleaned JOIN orders ON o_orderkey = id)"""


def key(id_expr: str, seed: int = 42) -> str:
    return f"md5('{seed}:' || {id_expr})"
