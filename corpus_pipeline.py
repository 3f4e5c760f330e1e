"""A corpus in five stages: language, near-duplicates, benchmark passages, secrets, token ids.

Each stage takes what the one before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reedbed.llm import bpe, decontaminate, language, near_dup, secret_scan
from reedbed.llm.common import materialize, parted, tokenizer_path
from reedbed.llm.queries import BYTE_BPE, table
from reedbed.session import bound_scans, show_package

#: No SQL: MinHash, Myers distances and BPE are not expressible; tests compare each stage with brute force.
ORACLE_SQL = None

#: What tells documents apart, ids and digests of texts.
KEY = ["doc_id", "_mark"]


def _marked(docs: DataFrame) -> DataFrame:
    """With the digest of the text, by which decisions come back: keys may be null or repeated, and all decisions but the
    choice among copies depend on the text alone."""
    return docs.withColumn("_mark", F.sha2(F.coalesce("text", F.lit("")), 256))


def _without(docs: DataFrame, gone: DataFrame, *names: str) -> DataFrame:
    """The documents without those whose values of these columns ``gone`` holds. It is written before, so that its size is
    known; and only documents that it is likely to hold are shuffled to find out."""
    kept, likely = parted(docs, gone, *names)
    gone = gone.select([F.col(n).alias(f"_gone_{n}") for n in names])
    return kept.unionByName(likely.join(gone, [F.col(n).eqNullSafe(F.col(f"_gone_{n}")) for n in names], "left_anti"))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; texts without a letter, null ones among them, go."""
    bound_scans(show_package(spark))
    languages, docs = language.learn(table(spark, sf_dir, "documents")), _marked(docs)
    gone = language.identify(docs, languages, key="_mark").where("lang_pred = 'und'").select("_mark").distinct()
    return _without(docs, materialize(gone, "gone"), "_mark").drop("_mark")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest id, any one of its repeated rows.

    Documents without an id come last. Texts without words are in no group and stay.
    """
    bound_scans(show_package(spark))
    docs = _marked(docs)
    # The order of keys is that of ids, nulls last, then of texts.
    keyed = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_mark").alias("key"), "text")
    found = near_dup.near_duplicates(keyed, key="key").groupBy("key.doc_id", "key._mark").agg(F.first("kept").alias("kept"), F.count("*").alias("rows"), F.max("n_shingles").alias("size"))
    # Most documents stay as they are; the others go, but for one row of those that are kept and repeated.
    others = materialize(found.where("NOT kept OR (rows > 1 AND size > 0)").select("doc_id", "_mark", "kept"), "others")
    again = materialize(others.where("kept").drop("kept"), "again")
    _, likely = parted(docs, again, *KEY)
    again = again.select([F.col(n).alias(f"_again_{n}") for n in KEY])
    ones = likely.join(again, [F.col(n).eqNullSafe(F.col(f"_again_{n}")) for n in KEY], "left_semi").dropDuplicates(KEY)
    return _without(docs, others, *KEY).unionByName(ones).drop("_mark")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    bound_scans(show_package(spark))
    docs = _marked(docs)
    gone = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), key="_mark").select("_mark").distinct()
    return _without(docs, materialize(gone, "gone"), "_mark").drop("_mark")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text and ``n_chars`` to match."""
    bound_scans(show_package(spark))
    return secret_scan.redact_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, and the packed ``ids`` of each text, which decode to it."""
    bound_scans(show_package(spark))
    coded = bpe.encode_documents(docs, tokenizer_path(BYTE_BPE))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("text_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identified),
    ("near_duplicates", deduplicated),
    ("benchmark_leaks", decontaminated),
    ("secrets", redacted),
    ("byte_bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
