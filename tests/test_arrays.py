"""Hand cases of framing, normalising, extraction and learning."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from reedbed.operators import arrays, learn
from reedbed.session import materialize


def signals(spark, *lengths):
    return spark.createDataFrame([(n, [float(i + 1) for i in range(n)]) for n in lengths], "id bigint, y array<float>")


def test_single_frames_are_padded_or_cut(spark):
    got = {r["id"]: r["y"] for r in arrays.frame_single(signals(spark, 0, 2, 4, 6), 4).collect()}
    assert got == {0: [0] * 4, 2: [1, 2, 0, 0], 4: [1, 2, 3, 4], 6: [1, 2, 3, 4]}


@pytest.mark.parametrize("n", [3, 4])
@pytest.mark.parametrize("hop", [1, 3, 4, 7])
@pytest.mark.parametrize(("max_samples", "max_chunks"), [(None, None), (5, None), (None, 2)])
def test_sliding_frames_follow_the_loop(spark, n, hop, max_samples, max_chunks):
    lengths = [0, 1, 3, 4, 8, 9, 10]
    want = []
    for length in lengths:
        y = [float(i + 1) for i in range(length)]
        limit = min(length, max_samples) if max_samples else length
        i, start = 0, 0
        while start < limit and (max_chunks is None or i < max_chunks):
            part = y[start : start + n]
            want.append((length, i, part + [0.0] * (n - len(part))))
            if start + n >= limit:
                break
            i, start = i + 1, start + hop
    got = arrays.frame_sliding(signals(spark, *lengths), n, hop, max_samples, max_chunks)
    assert rows(got, "id", "chunk_index", "y") == sorted(want, key=str)


def test_no_hop_gives_one_frame(spark):
    got = arrays.frame_sliding(signals(spark, 5), 3, None)
    assert rows(got, "chunk_index", "y") == [(0, [1.0, 2.0, 3.0])]


def test_normalising(spark):
    df = spark.createDataFrame([(1, [-100.0, -40.0, 5.0])], "id int, features array<double>")
    assert arrays.normalize_db_clip(df).first()["features"] == [-1.0, -0.5, 0.0]
    nan = float("nan")
    df = spark.createDataFrame([(1, [nan, -8.0])], "id int, features array<double>")
    clipped = arrays.normalize_db_clip(df).first()["features"]
    assert np.isnan(clipped[0]) and clipped[1] == -0.1
    given = [[2.0, 4.0], [3.0, 3.0], [], [nan, 0.0, 1.0], [nan]]
    df = spark.createDataFrame(list(enumerate(given)), "id int, features array<double>")
    got = [r["features"] for r in arrays.normalize_minmax(df).orderBy("id").collect()]
    assert got[0] == pytest.approx([0, 2 / (2 + 1e-8)]) and got[1] == [0.0, 0.0]
    assert got[2] is None and got[4] is None
    assert np.isnan(got[3][0]) and got[3][1:] == pytest.approx([0, 1], abs=1e-6)


def test_downmix(spark):
    data = [(1, [[1.0, 2.0], [3.0, 6.0]]), (2, [[5.0, 7.0]]), (3, [[0.0], [1.0], [5.0]])]
    got = arrays.downmix(spark.createDataFrame(data, "id int, channels array<array<float>>"))
    assert rows(got, "id", "y") == [(1, [2.0, 4.0]), (2, [5.0, 7.0]), (3, [2.0])]


def test_segments(spark):
    rng = np.random.default_rng(1)
    vectors = {i: rng.normal(size=(200 if i == 0 else i, 32)).astype("float32") for i in range(5)}
    vectors = {i: v for i, v in vectors.items() if len(v)}
    data = [(i, [list(map(float, x)) for x in v]) for i, v in vectors.items()]
    stacked = arrays.stack_segments(spark.createDataFrame(data, "id bigint, segments array<array<float>>"))
    assert stacked.count() == sum(map(len, vectors.values()))
    for row in arrays.pool_segments_mean(stacked).collect():
        v = vectors[row["id"]]
        assert row["num_segments"] == len(v) and row["features"] == pytest.approx(v.astype("float64").mean(axis=0))


def test_failed_rows_are_reported_and_the_rest_goes_on(spark):
    def extract(row):
        if len(row["y"]) == 2:
            raise ValueError("bad signal")
        return [[1.0], [2.0]] if len(row["y"]) == 3 else [sum(row["y"])]

    found = arrays.extract_features(signals(spark, 1, 2, 3), arrays.per_row_extractor(extract)).cache()
    good, failed = arrays.split_failures(found)
    assert rows(good, "id", "chunk_index", "features") == [(1, 0, [1.0]), (3, 0, [1.0]), (3, 1, [2.0])]
    assert rows(failed, "id", "error") == [(2, "ValueError: bad signal")]
    summary = arrays.preprocessing_summary(signals(spark, 1, 2, 3), good, failed, good.limit(0)).first()
    assert tuple(summary) == (3, 1, 0, 3)


def test_a_bad_row_does_not_cost_its_batch(spark):
    calls = spark.sparkContext.accumulator(0)

    def compute(batch):
        calls.add(1)
        sizes = [len(y) for y in batch.column("y").to_pylist()]
        if any(n % 50 == 7 for n in sizes):
            raise ValueError("bad signal")
        rows = [i for i, n in enumerate(sizes) for _ in range(n % 3)]
        index = [k for n in sizes for k in range(n % 3)]
        return pa.RecordBatch.from_pydict({"row": rows, "chunk_index": index, "features": [[float(sizes[i])] for i in rows]})

    lengths = list(range(1, 201))
    found = materialize(arrays.extract_features(signals(spark, *lengths), arrays.batch_extractor(compute), partitions=2), "found")
    good, failed = arrays.split_failures(found)
    bad = [n for n in lengths if n % 50 == 7]
    assert rows(failed, "id", "error") == sorted([(n, "ValueError: bad signal") for n in bad], key=str)
    want = [(n, k, [float(n)]) for n in lengths if n not in bad for k in range(n % 3)]
    assert rows(good, "id", "chunk_index", "features") == sorted(want, key=str)
    assert calls.value < 4 * 2 * 10  # two halves a level for each bad row


def test_rows_are_packed_by_weight(spark):
    # A few rows weigh as much as all others; null and negative weights count as nothing.
    weight = F.when(F.col("id") % 100 == 0, 5000).when(F.col("id") % 7 == 0, None).when(F.col("id") % 11 == 0, -3).otherwise(50)
    df = spark.range(4000).withColumn("w", weight).unionByName(spark.createDataFrame([(None, 50)], "id bigint, w int"))
    packed = arrays.pack_by_weight(df, F.col("w"), 20_000)
    total = df.agg(F.sum(F.greatest(F.coalesce("w", F.lit(0)), F.lit(0)) + 1)).first()[0]
    loads = packed.groupBy(F.spark_partition_id().alias("task")).agg(F.sum(F.greatest(F.coalesce("w", F.lit(0)), F.lit(0)) + 1).alias("load"))
    got = [r["load"] for r in loads.collect()]
    assert packed.rdd.getNumPartitions() == -(-total // 20_000) == len(got)
    assert max(got) < 20_000 + 2 * 5050
    assert rows(packed, "id", "w") == rows(df, "id", "w")
    assert arrays.pack_by_weight(df.limit(0), F.col("w"), 10).count() == 0


def test_learning_separates_two_clusters(spark):
    rng = np.random.default_rng(0)
    data = [(i, i % 2, [float(x) for x in rng.normal(loc=4 * (i % 2), size=3)]) for i in range(120)]
    df = spark.createDataFrame(data, "id int, class_label int, features array<float>")
    assert tuple(learn.training_classes(df).first()) == (2, 3)
    model = learn.train_mlp(df, hidden=4, max_iter=50)
    scored = learn.score_chunks(model, df)
    right = scored.filter(F.array_position("probs", F.array_max("probs")) - 1 == F.col("class_label")).count()
    assert right > 110
    assert scored.select(F.aggregate("probs", F.lit(0.0), lambda a, b: a + b).alias("s")).filter("abs(s - 1) > 1e-9").count() == 0


@pytest.mark.parametrize("bad", [[1.0], None])
def test_vectors_of_another_length_are_refused(spark, bad):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, bad)], "id int, features array<float>")
    with pytest.raises(Exception, match="expected 2 features"):
        learn.features_to_vector(df, 2).collect()
