"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reedbed.llm import bpe, chat, decontaminate, extract, hard_negatives, importance, language, line_dedup, merkle, near_dup, secret_scan, shards, token_counts
from reedbed.llm.common import scratch_dir, tokenizer_path
from reedbed.session import show_package

OVER_LIMIT = 4096
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return show_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its neighbour's last answer."""
    pairs = chat.format_pairs(chat.swapped_answers(table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return pairs.select(F.col("pair_id").alias("conv_id"), "prompt_turns", "prompt", "chosen", spans("chosen_mask").alias("chosen_mask"), "rejected", spans("rejected_mask").alias("rejected_mask"))


OP1_SQL = """
WITH whole AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS turns,
    coalesce(max(turn) FILTER (role = 'assistant'), 1e9::BIGINT) AS answer_turn,
    coalesce(arg_max(text, turn) FILTER (role = 'assistant'), NULL) AS answer
  FROM conversations GROUP BY conv_id),
kept AS (
  SELECT c.conv_id, list({'role': coalesce(c.role, ''), 'text': coalesce(c.text, '')} ORDER BY c.turn, coalesce(c.role, ''), coalesce(c.text, '')) AS turns
  FROM conversations c JOIN whole w ON c.conv_id = w.conv_id WHERE c.turn < w.answer_turn GROUP BY c.conv_id),
pairs AS (
  SELECT w.conv_id, w.turns AS a,
    list_concat(coalesce(k.turns, []), CASE WHEN o.answer IS NULL THEN [] ELSE [{'role': 'assistant', 'text': o.answer}] END) AS b
  FROM whole w LEFT JOIN kept k ON w.conv_id = k.conv_id LEFT JOIN whole o ON o.conv_id = xor(w.conv_id, 1)),
cut AS (
  SELECT conv_id, a, b,
    coalesce(list_position(list_transform(range(1, least(len(a), len(b)) + 1), lambda i: a[i] = b[i]), false) - 1, least(len(a), len(b)))::INTEGER AS p
  FROM pairs),
parts AS (SELECT conv_id, p, a[1:p] AS x, a[p + 1:] AS a, b[p + 1:] AS b FROM cut)
SELECT conv_id, p AS prompt_turns,
  coalesce(list_aggregate(list_transform(x, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') AS prompt,
  coalesce(list_aggregate(list_transform(a, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') AS chosen,
  coalesce(list_aggregate(list_filter(list_transform(range(1, len(a) + 1), lambda i: CASE WHEN a[i].role = 'assistant' THEN
    (coalesce(list_sum(list_transform(a[1:i - 1], lambda t: len(t.role) + len(t.text) + 13)), 0) + len(a[i].role) + 5)::BIGINT::VARCHAR || ':' ||
    (coalesce(list_sum(list_transform(a[1:i], lambda t: len(t.role) + len(t.text) + 13)), 0) - 1)::BIGINT::VARCHAR END), lambda s: s IS NOT NULL), 'string_agg', ','), '') AS chosen_mask,
  coalesce(list_aggregate(list_transform(b, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') AS rejected,
  coalesce(list_aggregate(list_filter(list_transform(range(1, len(b) + 1), lambda i: CASE WHEN b[i].role = 'assistant' THEN
    (coalesce(list_sum(list_transform(b[1:i - 1], lambda t: len(t.role) + len(t.text) + 13)), 0) + len(b[i].role) + 5)::BIGINT::VARCHAR || ':' ||
    (coalesce(list_sum(list_transform(b[1:i], lambda t: len(t.role) + len(t.text) + 13)), 0) - 1)::BIGINT::VARCHAR END), lambda s: s IS NOT NULL), 'string_agg', ','), '') AS rejected_mask
FROM parts
"""


def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.write_shards(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), scratch_dir(spark, "shards"), seed="training-order")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE), scratch_dir(spark, "token-counts"))
    return counted.withColumn("over_limit", F.col("n_tokens") > OVER_LIMIT)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_documents(table(spark, sf_dir, "documents"))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    many = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(many, secret_scan.KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_next(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th vector is an anchor; every 7th has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, list_dot_product(a.q, o.q)::BIGINT AS score
  FROM v a JOIN v o ON a.vec_id <> o.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
QUALIFY rank <= 3
"""


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.line_bitmaps(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "n_lines", "n_dropped", F.sha2(line_dedup.kept_text(F.col("text"), F.col("keep")), 256).alias("kept_sha256"))


OP12_SQL = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
firsts AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.*, coalesce(k.doc_id <> f.first, false) AS gone FROM keyed k LEFT JOIN firsts f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


#: The CRC goes over the bits of each different word, the lowest of a byte first.
OP13_SQL = """
WITH words AS (
  SELECT doc_id, true AS source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT NULL, false, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
counts AS (SELECT doc_id, source, word, count(*) AS n FROM words GROUP BY ALL),
bytes AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM counts)),
bits AS (
  SELECT word, list_concat([4294967295::BIGINT], list_transform(range(4 * len(h)), lambda i:
    ((strpos('0123456789ABCDEF', h[2 * (i // 8) + 2 - (i % 8) // 4]) - 1) >> (i % 4)::INTEGER) & 1)) AS b FROM bytes),
buckets AS (
  SELECT word, xor(list_reduce(b, lambda c, x: xor(c >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) % 10000 AS bucket FROM bits),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (source), 0) AS s, coalesce(sum(n) FILTER (NOT source), 0) AS t
  FROM counts JOIN buckets USING (word) GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln((g.t + 1)::DOUBLE * (a.s + 10000) / ((g.s + 1)::DOUBLE * (a.t + 10000))))::BIGINT AS gain
  FROM sums g, totals a),
weights AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counts JOIN buckets USING (word) JOIN gains USING (bucket) WHERE source GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank FROM placed
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_preference_pairs, op2_benchmark_leaks, op3_byte_bpe, op4_training_order, op5_token_counts, op6_near_duplicates, op7_secrets, op8_language, op9_main_text, op10_merkle, op11_hard_negatives, op12_line_dedup, op13_importance)
}
ORACLES: dict[str, str] = {"op1_preference_pairs": OP1_SQL, "op11_hard_negatives": OP11_SQL, "op12_line_dedup": OP12_SQL, "op13_importance": OP13_SQL}
