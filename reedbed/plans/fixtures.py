"""Recordings, chunk predictions and stores derived from the given tables.

Every frame grows with its tables; nothing is sampled or cut.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reedbed.config import OTHER, ClassMapping, EmbeddingSettings
from reedbed.operators.derive import cleaned_recordings, dashboard_frame
from reedbed.sources.embeddings import to_store_rows
from reedbed.sources.recordings import REQUIRED_COLUMNS, parse_list_columns

# The first fifteen brands play the target species.
TARGETS = tuple(f"Brand#{i}" for i in range(1, 16))
MAPPING = ClassMapping((OTHER, *TARGETS))
SETTINGS = EmbeddingSettings()
N_CLASSES = 10


# The layouts of the given tables, so that no read has to look into the files for them.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def recordings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw recordings in the CSV layout: orders with the brands of their items as species (every second has all,
    the others one of them); orders of a price divisible by four are unlabelled."""
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    part, customer, nation = (table(spark, sf_dir, t) for t in ("part", "customer", "nation"))
    species = (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("sp_id"))
        .agg(F.sort_array(F.collect_set("p_brand")).alias("every"))
        .withColumn("one", F.array(F.get("every", (F.col("sp_id") % F.size("every")).cast("int"))))
        .select("sp_id", F.when(F.col("sp_id") % 2 == 0, F.col("every")).otherwise(F.col("one")).alias("names"))
    )
    key = F.col("o_orderkey")
    names = F.concat(F.lit("['"), F.array_join("names", "', '"), F.lit("']"))
    numbers = F.transform("names", lambda n: F.substring_index(n, "#", -1))
    ids = F.concat(F.lit("["), F.array_join(numbers, ", "), F.lit("]"))
    no_text = F.lit(None).cast("string")
    return (
        orders.join(customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(species, (F.col("sp_id") == key) & (F.floor("o_totalprice") % 4 != 0), "left")
        .select(
            key.alias("id"),
            F.when(key % 29 == 0, None)
            .when(key % 31 == 0, "  ")
            .otherwise(F.concat(F.lit("https://audio.example/"), key.cast("string"), F.lit(".aac")))
            .alias("call_audio"),
            F.when(key % 13 == 0, False).when(key % 3 == 1, None).otherwise(True).alias("quality_call"),
            F.col("n_name").alias("state"),
            F.when(key % 37 != 0, F.timestamp_add("HOUR", (key % 24).cast("int"), "o_orderdate")).alias("capture_time"),
            ids.alias("validated_frog_ids"),
            names.alias("validated_frog_names"),
            no_text.alias("filters_readable"),
            F.when(key % 17 == 0, True).when(key % 5 == 0, None).otherwise(False).alias("is_duplicate"),
            F.when(key % 23 == 0, True).alias("inappropriate_content"),
            (key % 19 == 0).alias("has_people_activity"),
            no_text.alias("validator_note_public"),
            no_text.alias("validator_note_private"),
            F.when(F.col("o_orderstatus") == "P", "draft").otherwise("published").alias("validated_status"),
        )
        .select(*REQUIRED_COLUMNS)
    )


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_list_columns(recordings_raw(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str, anchor: str | None = None) -> DataFrame:
    return cleaned_recordings(recordings_raw(spark, sf_dir), MAPPING, anchor=anchor)


def report_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard_frame(recordings_raw(spark, sf_dir), TARGETS)


def split_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modelling ids, split by order priority; low-priority orders are left unused."""
    priority = F.col("o_orderpriority")
    split = (
        F.when(priority == "3-MEDIUM", "val").when(priority == "4-NOT SPECIFIED", "test").when(priority != "5-LOW", "train")
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), split.alias("split")).filter("split IS NOT NULL")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings whose audio is at hand: all but the urgent ones."""
    return table(spark, sf_dir, "orders").filter("o_orderpriority <> '1-URGENT'").select(F.col("o_orderkey").alias("id"))


def failed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings that were tried and did not arrive: the dear ones among the urgent."""
    dear = "o_orderpriority = '1-URGENT' AND o_totalprice > 250000"
    return table(spark, sf_dir, "orders").filter(dear).select(F.col("o_orderkey").alias("id"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as chunks: those of one label among fifty neighbours make a recording.

    Row by row, so it needs no order over a whole label. Chunk indexes have gaps.
    """
    return table(spark, sf_dir, "embeddings").select(
        (F.expr("vec_id div 50") * 10 + F.col("label")).alias("recording_id"),
        (F.col("vec_id") % 50).cast("int").alias("chunk_index"),
        F.col("label").alias("y_true"),
        "embedding",
        "vec_id",
    )


def _probs(embedding: str):
    # Class c has components c, c + 10, ... of the 64; each is used once.
    held = lambda c, k: F.coalesce(F.get(embedding, c + N_CLASSES * k).cast("double"), F.lit(0.0))
    scores = F.transform(F.sequence(F.lit(0), F.lit(N_CLASSES - 1)), lambda c: F.exp(reduce(add, (held(c, k) for k in range(7))) * 8))
    total = F.aggregate(scores, F.lit(0.0), lambda a, b: a + b)
    return F.transform(scores, lambda x: x / total)


def chunk_scorer(df: DataFrame) -> DataFrame:
    """Class probabilities from all components of the embedding."""
    return df.withColumn("probs", _probs("embedding"))


def chunk_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_scorer(chunks(spark, sf_dir)).select("recording_id", "chunk_index", "y_true", "probs")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks as feature rows with label columns."""
    return chunks(spark, sf_dir).select(
        F.col("recording_id").alias("id"),
        "chunk_index",
        F.col("embedding").alias("features"),
        F.col("y_true").alias("class_label"),
        F.concat(F.lit("sp"), F.col("y_true").cast("string")).alias("species_name"),
        "vec_id",
        (F.col("embedding")[0] > 0).alias("is_held"),
    )


def embedding_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks already held, by the sign of their first component, in the store's layout."""
    return to_store_rows(features(spark, sf_dir).filter("is_held"), SETTINGS)


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error analysis per embedding; class 0 is Other."""
    scored = table(spark, sf_dir, "embeddings").withColumn("p", _probs("embedding"))
    rows = scored.select(
        F.col("vec_id").alias("id"),
        F.col("label").alias("actual_class"),
        (F.array_position("p", F.array_max("p")) - 1).alias("pred_class"),
        F.array_max("p").alias("pred_class_prob"),
        F.concat(F.lit("sp"), (F.col("vec_id") % 7).cast("string")).alias("validated_frog_names"),
    )
    kind = (
        F.when(F.col("pred_class") == F.col("actual_class"), "correct")
        .when(F.col("actual_class") == 0, "other_as_target")
        .when(F.col("pred_class") == 0, "target_as_other")
        .otherwise("target_swap")
    )
    return rows.withColumns({"is_correct": F.col("pred_class") == F.col("actual_class"), "error_type": kind})


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model_id"),
        F.col("value").alias("prediction"),
        (F.col("event_id") % 50 + 10).cast("double").alias("label"),
    )


def test_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned recordings as rows of the Other-class analysis; the price of the order is the length of the recording."""
    lengths = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("duration_seconds"))
    return cleaned(spark, sf_dir, "first").join(lengths, "id").select(
        "id",
        F.col("class_label_single").alias("label"),
        F.col("species_name_single").alias("species_name"),
        "duration_seconds",
    )


def waveforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of unequal length: each embedding, followed by its own beginning."""
    signal = F.concat("embedding", F.slice("embedding", F.lit(1), (F.col("vec_id") % 32).cast("int")))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), signal.alias("y"))
