"""Hand cases and properties of sampling and splitting."""

import hashlib
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reedbed.config import SamplingStrategy
from reedbed.functions.ordering import hash_key, rank_by_hash, running_totals, take_by_hash, value_cuts
from reedbed.operators import sampling


def key(i, seed=42):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


def pool(spark, n=300, partitions=4):
    """A third of the rows in class 1, some without label, some Other or Mixed."""
    ids = spark.range(n, numPartitions=partitions)
    label = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 5 + 2).cast("int"))
    kind = F.when(F.col("id") % 11 == 0, "Mixed").when(F.col("id") % 4 == 1, "Other").otherwise("Target Only")
    return ids.select(
        "id", label.alias("class_label_single"), kind.alias("species_type"),
        F.array(F.concat(F.lit("s"), (F.col("id") % 9).cast("string"))).alias("species_names"),
        F.lit(False).alias("is_multi_species"),
    )


def targets(df):
    found = [(r["class_label_single"], r["id"]) for r in df.collect()
             if r["species_type"] == "Target Only" and r["class_label_single"] is not None]
    by_label = {}
    for label, i in found:
        by_label.setdefault(label, []).append(i)
    return {label: sorted(ids, key=key) for label, ids in by_label.items()}


@pytest.mark.parametrize("cap", [1, 10, 1000])
def test_downsample_takes_the_first_by_key(spark, cap):
    df = pool(spark)
    want = sorted(i for ids in targets(df).values() for i in ids[:cap])
    assert [r[0] for r in sampling.sample_target_downsample(df, cap).orderBy("id").select("id").collect()] == want


def test_no_cap_keeps_all_labelled_targets(spark):
    df = pool(spark)
    n = sum(map(len, targets(df).values()))
    assert sampling.sample_target_downsample(df, None).count() == sampling.sample_target_none(df).count() == n


@pytest.mark.parametrize("cap", [None, 30, 120])
def test_upsample_draws_max_of_size_and_cap(spark, cap, monkeypatch):
    monkeypatch.setattr(sampling, "DRAWS_PER_TASK_ROW", 7)
    df = pool(spark)
    got = Counter(r[0] for r in sampling.sample_target_upsample(df, cap).select("class_label_single").collect())
    sizes = {label: len(ids) for label, ids in targets(df).items()}
    assert got == {label: max(n, cap or n) for label, n in sizes.items()}


def test_same_rows_for_any_partitioning(spark):
    def drawn(n):
        df = pool(spark, partitions=n)
        return (
            rows(sampling.sample_target_downsample(df, 9), "id"),
            rows(sampling.sample_target_upsample(df, 50), "id", "draw"),
            rows(sampling.sample_other_random(df, 20), "id"),
            rows(sampling.sample_other_stratified(df, 20), "id"),
            rows(sampling.split_ids(df, "id", "class_label_single", "id", 0.2, 0.1), "id", "split"),
        )

    assert drawn(1) == drawn(4) == drawn(17)


def others(spark, sizes):
    data, i = [], 0
    for name, n in sizes.items():
        for _ in range(n):
            data.append((i, "Other", [name], 0))
            i += 1
    return spark.createDataFrame(data, "id bigint, species_type string, species_names array<string>, class_label_single int")


def test_stratified_share_and_top_up(spark):
    df = others(spark, {"a": 50, "b": 2, "c": 10})
    got = Counter(r[0][0] for r in sampling.sample_other_stratified(df, 20).select("species_names").collect())
    assert sum(got.values()) == 20 and got["b"] == 2 and got["a"] >= 6 and got["c"] >= 6


def test_more_lists_than_size_gives_one_row_each(spark):
    df = others(spark, {f"s{i}": 2 for i in range(30)})
    got = Counter(r[0][0] for r in sampling.sample_other_stratified(df, 10).select("species_names").collect())
    assert len(got) == 30 and set(got.values()) == {1}
    assert df.columns == sampling.sample_other_stratified(df, 10).columns
    assert sampling.sample_other_stratified(df.limit(0), 10).count() == 0
    assert sampling.sample_other_stratified(df, 0).count() == 0


def test_rare_other_rows_are_excluded(spark):
    df = others(spark, {"a": 5, "b": 2})
    assert sampling.exclude_rare_other(df, 3).count() == 5
    assert sampling.sample_other(df, "random", 100, 3).count() == 5
    with pytest.raises(ValueError):
        sampling.sample_other(df, "best", 1)


def test_modelling_set(spark):
    df = pool(spark)
    strategy = SamplingStrategy(max_samples_per_class=5, other_boost=2.5)  # round half to even: 12
    got = sampling.sample_modelling_dataset(df, strategy)
    kinds = Counter(r[0] for r in got.select("species_type").collect())
    assert kinds == {"Other": 12, "Target Only": 5 * len(targets(df))}
    ids = [r[0] for r in got.select("id").collect()]
    assert ids == sorted(ids, key=key)
    with pytest.raises(ValueError, match="max_samples_per_class"):
        sampling.sample_modelling_dataset(df, SamplingStrategy(max_samples_per_class=None))
    with pytest.raises(ValueError, match="unknown strategy"):
        sampling.sample_modelling_dataset(df, SamplingStrategy(species_data_to_use="nope"))
    up = SamplingStrategy(target_sampling="upsample", max_samples_per_class=200, other_boost=0.05)
    mixed = [r[0] for r in sampling.sample_modelling_dataset(df, up).select("id").collect()]
    assert len(mixed) == 200 * len(targets(df)) + 10
    assert sum(a == b for a, b in zip(mixed, mixed[1:])) < 50  # copies are spread
    assert sampling.sample_modelling_dataset(df, up).columns == df.columns
    alone = sampling.sample_modelling_dataset(df, SamplingStrategy(include_other=False, max_samples_per_class=None))
    assert alone.count() == sum(map(len, targets(df).values()))


def test_hold_out_leaves_used_ids_and_caps_labelled_rows(spark):
    df = pool(spark)
    used = df.filter("id < 100").select("id")
    assert sampling.sample_hold_out(df, used).count() == 200
    capped = sampling.sample_hold_out(df, used, None, 4)
    assert set(Counter(r[0] for r in capped.select("class_label_single").collect()).values()) == {4}
    assert capped.filter("id < 100 OR class_label_single IS NULL").count() == 0
    with pytest.raises(ValueError, match="class_label_single"):
        sampling.sample_hold_out(df.drop("class_label_single"), used, None, 4)


def chunk_rows(spark, labels, per_id=3):
    data = [(i, c, label) for i, label in enumerate(labels) for c in range(per_id)]
    return spark.createDataFrame(data, "id bigint, chunk_index int, label int")


def test_split_is_complete_disjoint_and_stratified(spark):
    df = chunk_rows(spark, [0] * 60 + [1] * 30 + [2] * 10)
    got = sampling.split_by_id(df, "id", "label", "chunk_index", 0.2, 0.1)
    assert got.count() == df.count()
    assert got.groupBy("id").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    sizes = {r["split"]: (r["num_ids"], r["num_rows"]) for r in sampling.split_sizes(got, "id").collect()}
    assert sizes == {"test": (20, 60), "val": (10, 30), "train": (70, 210)}
    tested = got.filter("split = 'test'").select("id", "label").distinct()
    assert Counter(r[1] for r in tested.collect()) == {0: 12, 1: 6, 2: 2}


@pytest.mark.parametrize("stratify", [True, False])
def test_too_few_ids_are_split_without_strata(spark, stratify):
    df = chunk_rows(spark, [0, 1, 2, 3, 4, 0, 1])
    got = sampling.split_ids(df, "id", "label", "chunk_index", 0.3, 0.15, stratify)
    ids = sorted(range(7), key=key)
    want = {i: "test" for i in ids[:2]} | {i: "val" for i in ids[2:3]} | {i: "train" for i in ids[3:]}
    assert {r["id"]: r["split"] for r in got.collect()} == want


def test_remainders_go_to_the_largest_then_the_smaller_class(spark):
    df = chunk_rows(spark, [0] * 5 + [1] * 5 + [2] * 5, per_id=1)
    tested = sampling.split_by_id(df, "id", "label", "chunk_index", 0.3, 0.0).filter("split = 'test'")
    assert Counter(r["label"] for r in tested.collect()) == {0: 2, 1: 1, 2: 1}


def test_split_joins_alike_without_broadcast(spark):
    df = chunk_rows(spark, [0] * 20 + [1] * 20, per_id=1)
    want = rows(sampling.split_ids(df, "id", "label", "chunk_index", 0.2, 0.2), "id", "split")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(sampling.split_ids(df, "id", "label", "chunk_index", 0.2, 0.2), "id", "split") == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranks_and_quotas_match_a_sort(spark):
    ids = spark.range(500).withColumn("g", (F.col("id") % 3 == 0).cast("int")).withColumn("k", hash_key("id", 1))
    want = {}
    for g in (0, 1):
        members = sorted((i for i in range(500) if (i % 3 == 0) == bool(g)), key=lambda i: key(i, 1))
        want |= {i: r + 1 for r, i in enumerate(members)}
    assert {r["id"]: r["rank"] for r in rank_by_hash(ids, ["g"], "k").collect()} == want
    quota = F.when(F.col("g") == 1, 7).otherwise(100)
    taken = {r["id"] for r in take_by_hash(ids, ["g"], "k", quota).collect()}
    assert taken == {i for i, r in want.items() if r <= (7 if i % 3 == 0 else 100)}
    everything = take_by_hash(ids, [], "k", 10_000)
    assert everything.count() == 500


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals_match_a_window(spark, descending):
    df = spark.range(400).select((F.col("id") % 2).alias("g"), (F.col("id") * 7 % 101 / 10).alias("x"), F.lit(1).alias("n"))
    df = df.groupBy("g", "x").agg(F.sum("n").alias("n"))
    got = running_totals(df, ["g"], "x", ["n"], value_cuts(df, "x"), descending).collect()
    all_rows = [(r["g"], r["x"], r["n"]) for r in df.collect()]
    for r in got:
        before = (lambda x: x >= r["x"]) if descending else (lambda x: x <= r["x"])
        assert r["n_run"] == sum(n for g, x, n in all_rows if g == r["g"] and before(x))
        assert r["n_total"] == sum(n for g, _, n in all_rows if g == r["g"])
    assert len(got) == len(all_rows)


@pytest.fixture
def fixed_partitions(spark):
    """Partitions as planned, so that their sizes can be looked at."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_one_class_is_ranked_by_many_tasks(spark, fixed_partitions):
    """Every row is of one class; with four partitions no task may hold much more than a quarter."""
    df = spark.range(20_000).select("id", F.lit(1).alias("g"), hash_key("id", 1).alias("k"))
    assert largest_share(rank_by_hash(df, ["g"], "k")) < 0.4
    assert largest_share(take_by_hash(df, ["g"], "k", 10_000)) < 0.4


def test_one_group_is_summed_by_many_tasks(spark, fixed_partitions):
    df = spark.range(20_000).select(F.lit(1).alias("g"), (F.col("id") / 7).alias("x"), F.lit(1).cast("bigint").alias("n"))
    summed = running_totals(df, ["g"], "x", ["n"], value_cuts(df, "x"), descending=True)
    # Sixteen ranges over four partitions by hash.
    assert largest_share(summed) < 0.6


def test_draws_of_one_class_are_made_by_many_tasks(spark):
    """The block rows are few and small; adaptive execution must not merge them into one task."""
    df = spark.range(50).select(
        "id", F.lit(1).alias("class_label_single"), F.lit("Target Only").alias("species_type")
    )
    plan = sampling.sample_target_upsample(df, 3_000_000)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    assert sampling.sample_target_upsample(df, 300_000).count() == 300_000
