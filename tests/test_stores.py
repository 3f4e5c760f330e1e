"""Stored tables, joins, monitoring and streams."""

import datetime as dt
from types import SimpleNamespace

import pytest
from conftest import rows

from reedbed.config import EmbeddingSettings
from reedbed.operators import joins, monitor
from reedbed.sources import artifacts, embeddings, versions
from reedbed.session import scratch_dir
from reedbed.sources.tables import read_table, write_table
from reedbed.streaming import jobs

SETTINGS = EmbeddingSettings()
FEATURE = "id bigint, chunk_index int, features array<float>, species_name string"


def feature_rows(spark, *keys):
    return spark.createDataFrame([(i, c, [float(i), float(c)], f"s{i}") for i, c in keys], FEATURE)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def test_embeddings_are_appended_by_recording_and_settings(spark, tmp_path):
    table = str(tmp_path / "store")
    embeddings.write_embeddings(feature_rows(spark, (1, 0), (12, 0)), table, SETTINGS)
    # Recording 1 counts as done although chunk 1 is new; 2 is appended.
    embeddings.write_embeddings(feature_rows(spark, (1, 0), (1, 1), (2, 0)), table, SETTINGS)
    store = embeddings.read_store(spark, table)
    assert rows(store, "audio_id", "chunk_index") == [("1", 0), ("12", 0), ("2", 0)]
    other = EmbeddingSettings(window_sec=5.0)
    embeddings.write_embeddings(feature_rows(spark, (1, 0)), table, other)
    store = embeddings.read_store(spark, table)
    assert store.count() == 4 and embeddings.at_settings(store, other).count() == 1
    # One wanted id is as good as many.
    got = embeddings.read_embeddings(ids(spark, 1), store, SETTINGS)
    assert rows(got, "id", "chunk_index", "features") == [(1, 0, [1.0, 0.0])]
    doubled = embeddings.read_embeddings(ids(spark, 1, 1), store, SETTINGS)
    assert doubled.count() == 2


def test_first_read_of_a_store_is_empty(spark, tmp_path):
    assert embeddings.read_store(spark, str(tmp_path / "none")).count() == 0
    assert embeddings.read_store(spark, "no_such_table").columns == embeddings.STORE_COLUMNS


def test_coverage_splits_rows(spark):
    store = embeddings.to_store_rows(feature_rows(spark, *[(7, c) for c in range(50)]), SETTINGS)
    stored, to_do = embeddings.embedding_coverage(feature_rows(spark, (7, 0), (7, 99), (77, 0)), store, SETTINGS)
    assert rows(stored, "id", "chunk_index") == [(7, 0), (7, 99)] and rows(to_do, "id") == [(77,)]


def test_a_batch_that_is_run_again_writes_nothing(spark, tmp_path):
    table, count = str(tmp_path / "store"), lambda: len(embeddings.read_store(spark, table).inputFiles())
    batch = feature_rows(spark, (1, 0), (1, 0), (2, 1))
    assert embeddings.append_new_chunks(batch, table, SETTINGS, 7, "s")
    assert embeddings.read_store(spark, table).count() == 2
    files = count()
    assert not embeddings.append_new_chunks(batch, table, SETTINGS, 7, "s") and count() == files
    # Before its note a batch is looked at, and adds what is missing only; other streams have numbers of their own.
    assert embeddings.append_new_chunks(feature_rows(spark, (1, 0), (3, 0)), table, SETTINGS, 7, "other")
    assert embeddings.append_new_chunks(batch, table, SETTINGS, 8, "s")
    assert sorted(r.audio_id for r in embeddings.read_store(spark, table).collect()) == ["1", "2", "3"]


def test_stores_without_buckets_are_read_and_extended(spark, tmp_path):
    table = str(tmp_path / "old")
    embeddings.to_store_rows(feature_rows(spark, (1, 0)), SETTINGS).write.partitionBy("embedding_from", "embedding_strategy").parquet(table)
    embeddings.write_embeddings(feature_rows(spark, (1, 0), (2, 0)), table, SETTINGS)
    assert embeddings.append_new_chunks(feature_rows(spark, (1, 0), (2, 0), (2, 1)), table, SETTINGS)
    assert sorted((r.audio_id, r.chunk_index) for r in embeddings.read_store(spark, table).collect()) == [("1", 0), ("2", 0), ("2", 1)]


def test_incremental_features_count_hits(spark):
    wanted = feature_rows(spark, (1, 0), (1, 1), (2, 0)).drop("features")
    hits, to_do, counts = embeddings.incremental_features(wanted, feature_rows(spark, (1, 0), (3, 0)))
    assert rows(hits, "id", "chunk_index", "features", "species_name") == [(1, 0, [1.0, 0.0], "s1")]
    assert rows(to_do, "id", "chunk_index") == [(1, 1), (2, 0)]
    assert tuple(counts.first()) == (3, 1, 2)
    twice = feature_rows(spark, (1, 0), (3, 0)).unionByName(feature_rows(spark, (1, 0)))
    again, _, counts = embeddings.incremental_features(wanted, twice)
    assert again.count() == 1 and tuple(counts.first()) == (3, 1, 2)


def test_catalog_tables_keep_their_format(spark, tmp_path):
    spark.sql(f"CREATE TABLE orc_rows (id BIGINT) USING orc LOCATION '{tmp_path / 'orc'}'")
    try:
        write_table(spark.range(3), "orc_rows")
        assert spark.table("orc_rows").count() == 3
    finally:
        spark.sql("DROP TABLE orc_rows")


def test_retention_is_by_exact_id(spark):
    store = spark.createDataFrame([(12, "npz"), (123, "npz"), (12, "PKL"), (12, None)], "id bigint, format string")
    kept, removed = embeddings.retain_features(store, ids(spark, 12))
    assert rows(kept, "id") == [(12,)] * 3 and rows(removed, "id") == [(123,)]
    kept, removed = embeddings.retain_features(store, ids(spark, 12, 12), ["pkl"])
    assert rows(kept, "format") == [("PKL",)] and removed.count() == 3
    with pytest.raises(ValueError, match="empty keep list"):
        embeddings.retain_features(store, ids(spark).limit(0))
    kept, removed = embeddings.retain_features(store, ids(spark).limit(0), allow_empty_keep=True)
    assert kept.count() == 0 and removed.count() == 4


def test_only_partitions_that_lose_rows_are_rewritten(spark, tmp_path, monkeypatch):
    root, by = str(tmp_path / "kept features"), ["part", "format"]
    data = [(i, f"0{i // 10}", "npz" if i % 2 else "p k:l") for i in range(40)]
    df = spark.createDataFrame(data, "id bigint, part string, format string")
    assert versions.create_versions(df, root, by) == 0
    with pytest.raises(ValueError, match="has versions"):
        versions.create_versions(df, root, by)
    old, _ = versions.version_folders(spark, root, 0)
    assert len(old) == 8

    keep = ids(spark, *[i for i in range(40) if i not in (3, 5, 32)])
    publish = versions._publish
    monkeypatch.setattr(versions, "_publish", lambda *args: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        versions.rewrite_retained(spark, root, by, keep)
    assert versions.latest_version(spark, root) == 0
    assert rows(versions.read_version(spark, root), "id", "part", "format") == sorted(data, key=str)

    monkeypatch.setattr(versions, "_publish", publish)
    version, removed = versions.rewrite_retained(spark, root, by, keep)
    assert version == 1 and rows(removed, "id") == [(3,), (32,), (5,)]
    new, layout = versions.version_folders(spark, root, 1)
    assert layout == df.schema
    assert sorted(set(old) - set(new)) == [f for f in old if "part=00/format=npz" in f or ("part=03" in f and "npz" not in f)]
    assert rows(versions.read_version(spark, root), "id", "part", "format") == sorted([r for r in data if r[0] not in (3, 5, 32)], key=str)
    assert versions.read_version(spark, root, 0).count() == 40

    assert versions.rewrite_retained(spark, root, by, keep)[0] == 1  # nothing more to lose
    with pytest.raises(ValueError, match="empty keep list"):
        versions.rewrite_retained(spark, root, by, ids(spark).limit(0))
    version, removed = versions.rewrite_retained(spark, root, by, ids(spark).limit(0), allow_empty_keep=True)
    assert version == 2 and removed.count() == 37
    empty = versions.read_version(spark, root)
    assert empty.count() == 0 and empty.columns == df.columns
    assert versions.rewrite_retained(spark, root, by, keep)[0] == 2


def test_merge_fills_missing_columns(spark):
    both = embeddings.merge_feature_sources(ids(spark, 1), feature_rows(spark, (2, 0)).select("id", "species_name"))
    assert rows(both, "id", "species_name") == [(1, None), (2, "s2")]


def test_audio_inventory_counts_digit_names_only(spark, tmp_path):
    for name in ("5.wav", "x7.wav", "8.mp3", "09.wav", "10_1.wav"):
        (tmp_path / name).write_bytes(b"x")
    assert rows(artifacts.scan_audio_inventory(spark, str(tmp_path), ".wav"), "id") == [(5,), (9,)]


def test_audio_inventory_goes_down_all_folders(spark, tmp_path):
    wanted = []
    for i, folder in enumerate((".", "a b", "a b/c%20d", "a b/c%20d/e", "x/y/z", "empty", "_hidden", "x/.hid")):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        if folder != "empty":
            for n in range(3):
                (tmp_path / folder / f"{10 * i + n}.wav").write_bytes(b"x")
            (tmp_path / folder / f"{i}9.WAV").write_bytes(b"x")
        if folder not in ("empty", "_hidden", "x/.hid"):
            wanted += [10 * i + n for n in range(3)]
    (tmp_path / "77.wav").mkdir()
    found = artifacts.scan_audio_inventory(spark, str(tmp_path), "wav")
    assert sorted(r["id"] for r in found.collect()) == sorted(wanted)
    # The same as Spark's own listing, which holds all file states in the driver.
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(str(tmp_path))
    assert rows(artifacts.ids_from_paths(listed.select("path"), "wav"), "id") == rows(found, "id")
    with pytest.raises(Exception, match="missing"):
        artifacts.scan_audio_inventory(spark, str(tmp_path / "missing"), "wav")


def test_the_manifest_notes_what_came_and_went(spark, tmp_path):
    manifest = str(tmp_path / "manifest")
    scan = lambda *values: rows(artifacts.update_inventory(ids(spark, *values), manifest), "id", "change")
    assert artifacts.inventory_ids(spark, manifest).count() == 0
    assert scan(1, 2, 2) == [(1, "added"), (2, "added")]
    assert scan(2, 1) == []
    assert scan(2, 3) == [(1, "gone"), (3, "added")]
    assert scan(1, 2, 3) == [(1, "added")]
    assert rows(artifacts.inventory_ids(spark, manifest), "id") == [(1,), (2,), (3,)]
    assert len(list((tmp_path / "manifest").glob("scan=*"))) == 3


def test_split_ids_are_read_back_alone_or_together(spark, tmp_path):
    given = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "id bigint, split string")
    path = str(tmp_path / "ids")
    assert rows(artifacts.split_ids_roundtrip(given, path), "id", "split") == [(1, "train"), (2, "val"), (3, "test")]
    assert rows(artifacts.read_split_ids(spark, path, "val"), "id") == [(2,)]


def test_latest_row_in_a_half_open_range(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    data = [("a", day(1), 1), ("a", day(2), 2), ("a", day(2), 3), ("a", day(3), 4), ("b", day(3), 5)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, n int")
    pick = lambda *r: rows(artifacts.feature_table_range(df, "ts", *r, ["k"], "n"), "k", "n")
    assert pick("2024-01-01", "2024-01-03") == [("a", 3)]
    assert pick(None, None) == [("a", 4), ("b", 5)] and pick("2024-01-03", None) == [("a", 4), ("b", 5)]


def test_joins(spark):
    rows_ = ids(spark, 1, 2, 3, 4)
    split = spark.createDataFrame([(1, "train"), (2, "test"), (9, "val")], "id bigint, split string")
    assert rows(joins.modelling_subset(rows_, split), "id") == [(1,), (2,)]
    assert rows(joins.modelling_subset(rows_, split, "test"), "id") == [(2,)]
    assert rows(joins.holdout_pool(rows_, split), "id") == [(3,), (4,)]
    found, missing = joins.reconcile_audio(rows_, ids(spark, 2, 2, 7))
    assert rows(found, "id") == [(2,)] and missing.count() == 3
    assert rows(joins.drop_missing_audio(rows_, ids(spark, 4)), "id") == [(1,), (2,), (3,)]


def test_download_counters(spark):
    required, have, failed = ids(spark, 1, 2, 3, 4), ids(spark, 1, 9), ids(spark, 2, 2, 8)
    got = joins.download_summary(required, have, failed).first().asDict()
    assert list(got.values()) == [4, 1, 3, 2, 1, 1, 3, False]
    offline = joins.download_summary(required, have, failed, can_download=False).first().asDict()
    assert list(offline.values()) == [4, 1, 3, 0, 0, 3, 1, False]
    assert joins.download_summary(required, required, failed).first()["has_complete_data"]


PREDS = "ts timestamp_ntz, model_id string, prediction double, label double"


def pred_rows(spark, *given):
    return spark.createDataFrame([(dt.datetime(2024, 1, d, h), m, p, 0.0) for d, h, m, p in given], PREDS)


def test_violation_looks_at_the_last_windows_only(spark):
    high = [(d, 1, "m", 200.0) for d in (1, 2, 3)]
    low = [(d, 1, "m", 1.0) for d in (4, 5, 6, 7)]
    daily = monitor.daily_metric(pred_rows(spark, *high, *low))
    assert tuple(monitor.metric_violation(daily).first()) == ("m", 5, 1, False)
    assert monitor.metric_violation(daily, n_eval=6).first()["is_violated"]


def test_daily_stream_equals_batch_on_closed_days_in_any_zone(spark, tmp_path):
    preds = pred_rows(spark, (1, 0, "m", 3.0), (1, 23, "m", 4.0), (1, 5, "n", 2.0), (2, 1, "m", 1.0), (3, 2, "m", 9.0))
    path = str(tmp_path / "preds")
    preds.write.parquet(path)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
    try:
        stream = jobs.stream_daily_metric(spark.readStream.schema(preds.schema).parquet(path))
        out = str(tmp_path / "out")
        jobs.write_stream(stream, out, str(tmp_path / "checkpoint")).awaitTermination()
        got = rows(spark.read.schema(stream.schema).parquet(out), "day", "model_id", "rmse", "num_predictions")
        batch = monitor.daily_metric(preds)
        want = rows(batch.filter("day < timestamp_ntz '2024-01-03'"), "day", "model_id", "rmse", "num_predictions")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == want and len(got) == 3


def test_late_rows_are_dropped_past_the_watermark(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("preds", "out", "checkpoint"))

    def step(*given):
        df = pred_rows(spark, *given)
        df.coalesce(1).write.mode("append").parquet(path)
        stream = jobs.stream_daily_metric(spark.readStream.schema(df.schema).parquet(path))
        jobs.write_stream(stream, out, checkpoint).awaitTermination()
        return rows(spark.read.schema(stream.schema).parquet(out), "day", "num_predictions")

    step((1, 1, "m", 1.0), (3, 5, "m", 1.0))
    got = step((1, 2, "m", 1.0), (5, 5, "m", 1.0))  # the row of day 1 is too late
    assert got == [(dt.datetime(2024, 1, 1), 1), (dt.datetime(2024, 1, 3), 1)]


def test_streamed_embeddings_are_stored_once(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "store")
    feature_rows(spark, (1, 0), (1, 1), (1, 1), (2, 0)).write.parquet(source)
    stream = spark.readStream.schema(feature_rows(spark, (1, 0)).schema).parquet(source)
    for run in range(2):  # a fresh checkpoint replays everything
        jobs.stream_append_embeddings(stream, table, SETTINGS, str(tmp_path / f"checkpoint{run}")).awaitTermination()
    assert rows(embeddings.read_store(spark, table), "audio_id", "chunk_index") == [("1", 0), ("1", 1), ("2", 0)]
    jobs.append_new_chunks(feature_rows(spark, (1, 0), (3, 0)), table, SETTINGS)
    assert embeddings.read_store(spark, table).count() == 4


def test_streamed_scores_equal_batch_scores(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = feature_rows(spark, (1, 0), (2, 1))
    df.write.parquet(source)
    scorer = lambda d: d.selectExpr("id", "features[0] * 2 AS score")
    stream = spark.readStream.schema(df.schema).parquet(source)
    jobs.stream_score(stream, scorer, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(spark.read.parquet(out), "id", "score") == rows(scorer(df), "id", "score")


def test_batch_scoring_replaces_the_output(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    ids(spark, 1, 2).write.parquet(source)
    for _ in range(2):
        got = artifacts.batch_score_table(spark, source, out, lambda d: d.selectExpr("id", "id * 2 AS score"))
    assert rows(got, "id", "score") == [(1, 2), (2, 4)] == rows(read_table(spark, out), "id", "score")


def test_scratch_folder_is_the_one_the_session_names():
    def session(folder, master):
        conf = SimpleNamespace(get=lambda name, default=None: {"spark.checkpoint.dir": folder}.get(name) or default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))

    assert scratch_dir(session("hdfs://shared/", "spark://host"), "x").startswith("hdfs://shared/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session(None, "spark://host"), "x")
    assert "reedbed-" in scratch_dir(session(None, "local[2]"), "x")
