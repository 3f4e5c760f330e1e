"""Hand cases of the distributions."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from reedbed.functions.columns import percent
from reedbed.operators import reports


def test_percent_rounds_half_to_even_and_has_no_value_without_base(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (1, 200), (0, 0)], "a int, b int")
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"), 0)).collect()]
    assert got == [12.0, 38.0, 0.0, None]


def report(spark):
    data = [
        (1, ["a", "x"], True, 2, True, "NSW", "2020-01-01 01:00:00"),
        (2, ["a"], True, 1, False, None, None),
        (3, ["x", "y"], False, 2, True, "VIC", "2021-02-01 02:00:00"),
        (4, ["y"], False, 1, False, "VIC", "2021-02-03 02:00:00"),
        (5, ["a", "b"], True, 2, True, "VIC", "2021-03-03 05:00:00"),
    ]
    df = spark.createDataFrame(
        data,
        "id int, sorted_species_names array<string>, includes_target_species boolean, species_count int, is_multi_species boolean, "
        "state string, t string",
    )
    return df.withColumn("capture_time", F.col("t").cast("timestamp_ntz")).withColumn(
        "first_species_name", F.col("sorted_species_names")[0]
    )


def test_shares_keep_their_bases(spark):
    df, targets = report(spark), ("a", "b")
    assert rows(reports.occurrence_distribution(df), "species", "count", "percentage") == [
        ("a", 3, 38.0), ("b", 1, 12.0), ("x", 2, 25.0), ("y", 2, 25.0)]
    assert rows(reports.target_occurrence_distribution(df, targets), "species", "percentage") == [("a", 38.0), ("b", 12.0)]
    # The row without time counts in the base.
    assert rows(reports.records_by_year(df), "year", "count", "percentage") == [(2020, 1, 20.0), (2021, 3, 60.0)]
    assert rows(reports.records_by_month(df), "month", "count") == [("Feb", 2), ("Jan", 1), ("Mar", 1)]
    assert rows(reports.records_by_hour(df), "hour", "count") == [(1, 1), (2, 2), (5, 1)]
    multi = rows(reports.multi_target_distribution(df, targets), "species", "count", "percentage")
    assert multi == [("a", 2, 100.0), ("b", 1, 50.0)]
    assert rows(reports.single_target_distribution(df), "species", "percentage") == [("a", 100.0)]
    assert rows(reports.single_other_distribution(df), "species", "count") == [("y", 1)]
    assert rows(reports.multi_other_distribution(df, targets), "species", "count") == [("x", 1), ("y", 1)]
    assert rows(reports.target_by_state(df, targets), "species", "state", "count") == [
        ("a", "NSW", 1), ("a", "VIC", 1), ("b", "VIC", 1)]
    by_year = reports.target_by_year(df, targets)
    assert [tuple(r) for r in reports.top_species_by_total(by_year, 1).collect()] == [("a", 2)]
    assert reports.mean_species_count(df).first()[0] == 1.6


def test_pairs(spark):
    df = report(spark)
    got = rows(reports.species_pairs(df, ("a", "b")), "id", "target_count", "target_species", "has_target", "combination_type")
    assert got == [(1, 1, ["a"], True, "target_other"), (3, 0, [], False, "other_other"), (5, 2, ["a", "b"], True, "target_target")]
    assert rows(reports.pair_type_distribution(df, ("a", "b")), "combination_type", "percentage")[0] == ("other_other", 33.0)


def test_total_row_counts_shown_groups_but_species_of_all_rows(spark):
    data = [(1, False, ["a"]), (1, True, ["a", "b"]), (2, False, []), (None, False, ["z"])]
    df = spark.createDataFrame(data, "label int, is_multi_species boolean, species_names array<string>")
    got = rows(reports.grouped_distribution_total(df, ["label"]), "label", "is_total", "unique_species", "single_species", "multi_species", "total")
    assert got == [(1, False, 2, 1, 1, 2), (2, False, 0, 1, 0, 1), (None, True, 3, 2, 1, 3)]
    assert reports.grouped_distribution(df, ["label"]).count() == 2


def test_concentration_and_top_n(spark):
    names = ["a"] * 6 + ["b"] * 4 + ["c"] + ["d"] + ["e"] + ["f"]
    df = spark.createDataFrame([(0, n) for n in names] + [(1, "q"), (0, None)], "label int, species_name string")
    got = reports.other_concentration(df, 0).first().asDict()
    assert got == {"unique_species": 6, "singletons": 4, "few_samples": 5, "percent_few": 83.3, "top_5_sum": 13, "total": 14,
                   "percent_top_5": 92.9}
    assert [tuple(r) for r in reports.species_top_n(df, 3).collect()] == [("a", 6), ("b", 4), ("c", 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_quartiles_match_numpy_also_for_a_hot_species(spark, seed):
    rng = np.random.default_rng(seed)
    values = {"hot": rng.normal(size=2000).round(2), "one": np.array([4.0]), "two": np.array([1.0, 2.0]), "same": np.ones(50)}
    df = spark.createDataFrame([(s, float(v)) for s, vs in values.items() for v in vs], "species_name string, x double")
    for row in reports.describe_by_species(df, "x").collect():
        vs = values[row["species_name"]]
        want = [len(vs), vs.mean(), *np.quantile(vs, [0.25, 0.5, 0.75]), vs.min(), vs.max()]
        assert [row[c] for c in ("count", "mean", "p25", "p50", "p75", "min", "max")] == pytest.approx(want)
        if len(vs) > 1:
            assert row["std"] == pytest.approx(vs.std(ddof=1))
        else:
            assert row["std"] is None


def test_confusion_rate_bases_differ(spark):
    data = [(1, 0, 2, 0.5, False, "x"), (2, 0, 2, 0.7, False, "x"), (3, 0, 1, 0.9, False, "x"), (4, 0, 0, 0.9, True, "x"),
            (5, 2, 0, 0.4, False, "t"), (6, 2, 2, 0.8, True, "t"), (7, 3, 3, 0.8, True, "t")]
    df = spark.createDataFrame(data, "id int, actual_class int, pred_class int, pred_class_prob double, is_correct boolean, validated_frog_names string")
    named = lambda c: F.concat(F.lit("n"), c.cast("string"))
    got = [(r["confused_target"], r["rate_cases"], r["mean_confidence"]) for r in reports.other_as_target_confusion(df, 0, named).collect()]
    assert got == [("n2", "2 / 3", pytest.approx(0.6)), ("n1", "1 / 3", 0.9)]
    got = [(r["target_species"], r["rate_cases"]) for r in reports.target_as_other_confusion(df, 0, named).collect()]
    assert got == [("n2", "1 / 2")]
    assert reports.other_accuracy(df, 0).first()["other_accuracy"] == 0.25
    assert rows(reports.per_species_accuracy(df, 0), "validated_frog_names", "count", "accuracy") == [("x", 4, 0.25)]
