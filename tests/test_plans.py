"""Shapes of physical plans that matter on large data."""

from pyspark.sql import functions as F

from reedbed.config import EmbeddingSettings, SamplingStrategy
from reedbed.operators import anchors, clean, pooling, reports, sampling, strategies
from reedbed.plans import fixtures as fx
from reedbed.sources import artifacts, embeddings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fixed_settings_read_their_folder_only(spark, tmp_path):
    table = str(tmp_path / "store")
    rows = spark.range(4).select("id", F.lit(0).alias("chunk_index"), F.array(F.lit(1.0)).alias("features"), F.lit("s").alias("species_name"))
    for source in ("net-a", "net-b"):
        embeddings.write_embeddings(rows, table, EmbeddingSettings(source=source))
    text = plan(embeddings.at_settings(embeddings.read_store(spark, table), EmbeddingSettings(source="net-a")).select("audio_id"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "embedding_from" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "embedding:" not in scan  # the vectors are not read


def test_funnel_is_one_scan_and_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "raw")
    fx.parsed(spark, "/root/testdata/sf0.001").write.parquet(path)
    text = plan(clean.filter_funnel(spark.read.parquet(path)))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "state" not in text.split("ReadSchema")[1]


def test_cleaning_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    fx.parsed(spark, "/root/testdata/sf0.001").write.parquet(path)
    text = plan(clean.clean_recordings(spark.read.parquet(path)).select("id"))
    assert "EqualTo(validated_status,published)" in text and "IsNotNull(call_audio)" in text


def test_rank_limits_run_before_the_shuffle(spark):
    chunks = fx.chunk_probs(spark, "/root/testdata/sf0.001")
    events = fx.table(spark, "/root/testdata/sf0.001", "events")
    latest = artifacts.feature_table_range(events, "ts", "2024-01-05", None, ["user_id"], "event_id")
    for df in (pooling.pool_topk(chunks, fx.N_CLASSES, 3), latest):
        text = plan(df)
        assert text.index("Final") < text.index("Exchange hashpartitioning") and "row_number(), " in text and "Partial" in text
    assert "GreaterThanOrEqual(ts" in plan(latest)


def test_reports_group_once(spark, tmp_path):
    path = str(tmp_path / "report")
    fx.report_frame(spark, "/root/testdata/sf0.001").write.parquet(path)
    report = spark.read.parquet(path)
    text = plan(reports.records_by_year(report))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<capture_time:timestamp_ntz>" in text
    assert plan(reports.multi_target_distribution(report, fx.TARGETS)).count("FileScan") == 1


def recordings(spark, tmp_path):
    """Labelled recordings as a stored table, so that scans of it can be counted."""
    path = str(tmp_path / "recordings")
    label = F.when(F.col("id") % 3 > 0, (F.col("id") % 4).cast("int")).otherwise(0)
    kind = F.when(F.col("id") % 3 > 0, "Target Only").otherwise("Other")
    names = F.array(F.concat(F.lit("s"), (F.col("id") % 7).cast("string")))
    spark.range(600).select("id", label.alias("class_label_single"), kind.alias("species_type"), names.alias("species_names"), F.lit("x").alias("notes")).write.parquet(path)
    return spark.read.parquet(path)


def scans(df, tmp_path):
    """Scans of what the test has stored; long paths are cut in plans."""
    return sum("FileScan" in line and str(tmp_path.parent.parent) in line for line in plan(df).splitlines())


def test_samplers_scan_their_source_once(spark, tmp_path):
    df = recordings(spark, tmp_path)
    used = spark.range(100).toDF("id")
    drawn = [
        sampling.sample_target_downsample(df, 20),
        sampling.sample_target_upsample(df, 150),
        sampling.sample_other_random(df, 30),
        sampling.sample_other_stratified(df, 30),
        sampling.sample_hold_out(df, used, cap=10),
        sampling.sample_modelling_dataset(df, SamplingStrategy(species_data_to_use=None, target_sampling="upsample", max_samples_per_class=50, include_other=True, other_sampling="stratify", exclude_other_below_count=2)),
    ]
    assert [scans(d, tmp_path) for d in drawn] == [1] * len(drawn)
    # A cut is a filter on the scan: the rows themselves are not shuffled.
    assert "hashpartitioning" not in plan(drawn[0]) and "hashpartitioning" not in plan(drawn[2])


def test_what_depends_on_species_lists_plans_the_source_once(spark, tmp_path):
    df = recordings(spark, tmp_path)
    assert scans(anchors.anchor_most_frequent(df), tmp_path) == 1
    assert scans(strategies.rare_species_only(df, 90), tmp_path) == 1


def test_batches_read_their_buckets_only(spark, tmp_path):
    table, settings = str(tmp_path / "store"), EmbeddingSettings()
    rows = lambda ids: ids.select("id", F.lit(0).alias("chunk_index"), F.array(F.lit(1.0)).alias("features"), F.lit("s").alias("species_name"))
    embeddings.write_embeddings(rows(spark.range(500)), table, settings)
    store = embeddings.read_buckets(spark, table)
    near = embeddings.in_buckets_of(embeddings.at_settings(store, settings), spark.createDataFrame([("7",), ("8",)], "audio_id string"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        scan = next(line for line in plan(near.select("audio_id")).splitlines() if "FileScan" in line)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "id_bucket" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    files = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
    assert files(near) <= 2 < files(store)
    assert {r[0] for r in near.select("audio_id").collect()} >= {"7", "8"}
