"""Distributions and summaries over cleaned recordings and the report frame.

Totals for percentages are window sums over already grouped rows: their number is
that of species, years or states, not that of recordings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reedbed.functions.columns import half_even, only, percent, ratio
from reedbed.functions.ordering import running_totals, value_cuts
from reedbed.operators.clean import keep_condition
from reedbed.operators.derive import dashboard_columns
from reedbed.session import materialize

# Fixed values.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _rows() -> Column:
    return F.count(F.lit(1))


def _total(count: str | Column) -> Column:
    """Sum over all (already grouped) rows."""
    return F.sum(count).over(Window.partitionBy())


def _not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def _by_group_and_species(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and occurrences per (group, species) in one pass; a row counts at its first species."""
    spread = df.select(*by, "is_multi_species", F.posexplode_outer("species_names").alias("_pos", "_species"))
    first = F.coalesce(F.col("_pos") == 0, F.lit(True))
    return spread.groupBy(*by, "_species").agg(
        F.count_if(first & ~F.col("is_multi_species")).alias("single_species"),
        F.count_if(first & F.col("is_multi_species")).alias("multi_species"),
    )


def grouped_distribution(df: DataFrame, by: Sequence[str], count_col: str = "total") -> DataFrame:
    """Per group: unique species, single- and multi-species rows, all rows. Null keys drop out."""
    sums = _by_group_and_species(df.filter(_not_null(by)), by).groupBy(*by).agg(
        F.count("_species").alias("unique_species"),
        F.sum("single_species").alias("single_species"),
        F.sum("multi_species").alias("multi_species"),
    )
    return sums.withColumn(count_col, F.col("single_species") + F.col("multi_species")).orderBy(*by)


def grouped_distribution_total(df: DataFrame, by: Sequence[str], count_col: str = "total") -> DataFrame:
    """The grouped distribution and a TOTAL row, told apart by ``is_total``.

    Counts of the TOTAL row cover the shown groups; its unique species cover all of ``df``.
    """
    table = _by_group_and_species(df, by)
    # Each species counts in the total where it comes up first, in a group without key too.
    first = F.row_number().over(Window.partitionBy("_species").orderBy(*by)) == 1
    marked = table.withColumn("_new", (first & F.col("_species").isNotNull()).cast("int")).withColumn("_keyed", _not_null(by))
    counts = [F.sum(F.when(F.col("_keyed"), F.col(c)).otherwise(0)).alias(c) for c in ("single_species", "multi_species")]
    sums = marked.groupingSets([list(map(F.col, by)), []], *by).agg(
        F.grouping_id().alias("_gid"), F.count("_species").alias("_in_group"), F.sum("_new").alias("_in_all"), *counts
    )
    total = F.col("_gid") != 0
    return sums.filter(total | _not_null(by)).select(
        *by,
        total.alias("is_total"),
        F.when(total, F.col("_in_all")).otherwise(F.col("_in_group")).alias("unique_species"),
        "single_species",
        "multi_species",
        (F.col("single_species") + F.col("multi_species")).alias(count_col),
    )


def _species_counts(df: DataFrame) -> DataFrame:
    species = df.select(F.explode("sorted_species_names").alias("species")).filter(F.col("species").isNotNull())
    return species.groupBy("species").agg(_rows().alias("count"))


def occurrence_distribution(df: DataFrame) -> DataFrame:
    """Occurrences per species and their percent of all occurrences."""
    total = _total("count")
    return _species_counts(df).withColumn("percentage", percent(F.col("count"), total, 0))


def target_occurrence_distribution(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """The same for targets; the base stays all occurrences."""
    return occurrence_distribution(df).filter(F.col("species").isin(list(targets)))


def target_by_state(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Recordings per target species and state."""
    found = F.array_distinct(only(F.col("sorted_species_names"), targets))
    rows = df.filter("includes_target_species").select("state", F.explode(found).alias("species"))
    return rows.filter(F.col("state").isNotNull()).groupBy("species", "state").agg(_rows().alias("count"))


def order_by_total(counts: DataFrame, by: str) -> DataFrame:
    """Totals of a count table in descending order."""
    return counts.groupBy(by).agg(F.sum("count").alias("total")).orderBy(F.col("total").desc(), by)


def target_by_year(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Recordings per target species and year."""
    found = F.array_distinct(only(F.col("sorted_species_names"), targets))
    rows = df.select(F.year("capture_time").alias("year"), F.explode(found).alias("species"))
    return rows.filter(F.col("year").isNotNull()).groupBy("species", "year").agg(_rows().alias("count"))


def top_species_by_total(counts: DataFrame, k: int = 3) -> DataFrame:
    return order_by_total(counts, "species").limit(k)


def _share_of_rows(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Rows per value, percent of all rows. Rows without a value count in the base only."""
    counts = df.groupBy(value.alias(name)).agg(_rows().alias("count"))
    total = _total("count")
    return counts.withColumn("percentage", percent(F.col("count"), total, 0)).filter(F.col(name).isNotNull())


def records_by_year(df: DataFrame) -> DataFrame:
    return _share_of_rows(df, F.year("capture_time"), "year").orderBy("year")


def records_by_month(df: DataFrame) -> DataFrame:
    months = _share_of_rows(df, F.month("capture_time"), "month_number")
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return months.select("month_number", F.element_at(names, F.col("month_number")).alias("month"), "count", "percentage").orderBy(
        "month_number"
    )


def records_by_hour(df: DataFrame) -> DataFrame:
    return _share_of_rows(df, F.hour("capture_time"), "hour").orderBy("hour")


def _by_first_species(df: DataFrame) -> DataFrame:
    known = df.filter(F.col("first_species_name").isNotNull())
    return known.groupBy(F.col("first_species_name").alias("species")).agg(_rows().alias("count"))


def single_target_distribution(df: DataFrame) -> DataFrame:
    """Single-species recordings per target; percent of the shown counts, not rounded."""
    shown = _by_first_species(df.filter(F.col("includes_target_species") & ~F.col("is_multi_species")))
    return shown.withColumn("percentage", F.col("count") / _total("count") * 100)


def single_other_distribution(df: DataFrame) -> DataFrame:
    return _by_first_species(df.filter(~F.col("includes_target_species") & ~F.col("is_multi_species")))


def multi_target_distribution(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Targets in multi-species recordings; percent of those recordings, so the sum may pass 100."""
    rows = df.filter(F.col("includes_target_species") & F.col("is_multi_species"))
    # The leading null entry of every row counts the recordings in the same pass.
    entries = F.concat(F.array(F.lit(None).cast("string")), only(F.col("sorted_species_names"), targets))
    counts = rows.select(F.explode(entries).alias("species")).groupBy("species").agg(_rows().alias("count"))
    recordings = _total(F.when(F.col("species").isNull(), F.col("count")))
    return counts.withColumn("percentage", F.col("count") / recordings * 100).filter(F.col("species").isNotNull())


def multi_other_distribution(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    rows = df.filter(~F.col("includes_target_species") & F.col("is_multi_species"))
    return _species_counts(rows).filter(~F.col("species").isin(list(targets)))


def species_per_recording(df: DataFrame) -> DataFrame:
    return _share_of_rows(df, F.col("species_count"), "species_count").orderBy("species_count")


def mean_species_count(df: DataFrame) -> DataFrame:
    return df.agg(half_even(F.avg("species_count"), 2).alias("mean_species_count"))


def species_pairs(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """One row per two-species recording: the pair, its targets and its kind."""
    names = F.col("sorted_species_names")
    found = F.sort_array(F.array_intersect(names, F.array(*[F.lit(t) for t in targets])))
    pairs = df.filter(F.col("species_count") == 2).select(
        "id",
        F.try_element_at(names, F.lit(1)).alias("species_1"),
        F.try_element_at(names, F.lit(2)).alias("species_2"),
        found.alias("target_species"),
        F.size(found).alias("target_count"),
    )
    kind = (
        F.when(F.col("target_count") == 2, "target_target")
        .when(F.col("target_count") == 1, "target_other")
        .otherwise("other_other")
    )
    return pairs.withColumn("has_target", F.col("target_count") > 0).withColumn("combination_type", kind)


def pair_type_distribution(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    return _share_of_rows(species_pairs(df, targets), F.col("combination_type"), "combination_type")


def dataset_summary(raw: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Counts, percents and species numbers of raw, filtered, single and multi rows in one row.

    ``raw`` has parsed lists. One pass groups by species; a recording counts at its first
    entry. All distinct counts then run over that species table.
    """
    names = F.col("validated_frog_names")
    flagged = raw.withColumn("_kept", keep_condition()).transform(dashboard_columns, targets)
    spread = flagged.select(
        "_kept",
        F.col("is_multi_species").alias("_multi"),
        F.col("includes_target_species").alias("_target"),
        "first_species_name",
        F.posexplode_outer(names).alias("_pos", "species"),
    ).withColumn("_first", F.coalesce(F.col("_pos") == 0, F.lit(True)))
    kept, multi, target, first = (F.col(c) for c in ("_kept", "_multi", "_target", "_first"))
    # A single-species row is named after its first entry.
    named = F.col("species") == F.col("first_species_name")
    per_species = spread.groupBy("species").agg(
        F.count_if(first).alias("raw"),
        F.count_if(first & kept & ~multi & target).alias("st"),
        F.count_if(first & kept & ~multi & ~target).alias("so"),
        F.count_if(first & kept & multi & target).alias("mt"),
        F.count_if(first & kept & multi & ~target).alias("mo"),
        F.count_if(kept).alias("occ"),
        F.count_if(kept & ~multi & target & named).alias("n_st"),
        F.count_if(kept & ~multi & ~target & named).alias("n_so"),
        F.count_if(kept & multi & target).alias("n_mt"),
        F.count_if(kept & multi & ~target).alias("n_mo"),
    )
    known = F.col("species").isNotNull()
    is_target = F.col("species").isin(list(targets))
    sums = per_species.agg(
        *[F.sum(c).alias(c) for c in ("raw", "st", "so", "mt", "mo")],
        F.count_if(known).alias("raw_num_species"),
        F.sum(F.when(known, F.col("occ")).otherwise(0)).alias("filtered_count_species_occurrences"),
        F.sum(F.when(known & is_target, F.col("occ")).otherwise(0)).alias("filtered_count_target_occurrences"),
        F.count_if(known & (F.col("occ") > 0)).alias("filtered_num_species"),
        F.count_if(known & (F.col("n_st") + F.col("n_so") > 0)).alias("single_num_species"),
        F.count_if(known & (F.col("n_st") > 0)).alias("single_num_target_species"),
        F.count_if(known & (F.col("n_so") > 0)).alias("single_num_other_species"),
        F.count_if(known & (F.col("n_mt") + F.col("n_mo") > 0)).alias("multi_num_species"),
        F.count_if(known & (F.col("n_mt") > 0)).alias("multi_num_target_species"),
        F.count_if(known & (F.col("n_mo") > 0)).alias("multi_num_other_species"),
    )
    c = F.col
    single, multi_rows = c("st") + c("so"), c("mt") + c("mo")
    total = single + multi_rows
    return sums.select(
        c("raw").alias("raw_count_total"),
        "raw_num_species",
        total.alias("filtered_count_total"),
        percent(total, c("raw"), 0).alias("filtered_percent_of_raw"),
        "filtered_num_species",
        "filtered_count_species_occurrences",
        "filtered_count_target_occurrences",
        percent(c("filtered_count_target_occurrences"), c("filtered_count_species_occurrences"), 0).alias(
            "filtered_percent_target_occurrences"
        ),
        single.alias("single_count_total"),
        c("st").alias("single_count_target"),
        c("so").alias("single_count_other"),
        percent(single, total, 0).alias("single_percent_of_total"),
        percent(c("st"), total, 0).alias("single_percent_target_of_total"),
        percent(c("so"), total, 0).alias("single_percent_other_of_total"),
        percent(c("st"), single, 0).alias("single_percent_target_of_single"),
        percent(c("so"), single, 0).alias("single_percent_other_of_single"),
        "single_num_species",
        "single_num_target_species",
        "single_num_other_species",
        multi_rows.alias("multi_count_total"),
        c("mt").alias("multi_count_target"),
        c("mo").alias("multi_count_other"),
        percent(multi_rows, total, 0).alias("multi_percent_of_total"),
        percent(c("mt"), total, 0).alias("multi_percent_target_of_total"),
        percent(c("mo"), total, 0).alias("multi_percent_other_of_total"),
        percent(c("mt"), multi_rows, 0).alias("multi_percent_target_of_multi"),
        percent(c("mo"), multi_rows, 0).alias("multi_percent_other_of_multi"),
        "multi_num_species",
        "multi_num_target_species",
        "multi_num_other_species",
    )


def class_support(df: DataFrame, label: str = "class_label_single") -> DataFrame:
    """Number of samples and of distinct labels."""
    return df.agg(_rows().alias("num_samples"), F.count_distinct(label).alias("num_labels"))


def species_top_n(df: DataFrame, n: int, col: str = "species_name") -> DataFrame:
    """The ``n`` most frequent values, ties by name."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(_rows().alias("count"))
    return counts.orderBy(F.col("count").desc(), col).limit(n)


def other_value_counts(test_ids: DataFrame, other_label: int) -> DataFrame:
    """Species inside the Other class."""
    rows = test_ids.filter((F.col("label") == other_label) & F.col("species_name").isNotNull())
    return rows.groupBy("species_name").agg(_rows().alias("count"))


def other_concentration(test_ids: DataFrame, other_label: int) -> DataFrame:
    """How the Other class is spread: species, singletons, species below 5, share of the top 5."""
    counts = other_value_counts(test_ids, other_label)
    top_5 = counts.orderBy(F.col("count").desc(), "species_name").limit(5).agg(F.sum("count")).scalar()
    few = F.count_if(F.col("count") < 5)
    sums = counts.agg(
        _rows().alias("unique_species"),
        F.count_if(F.col("count") == 1).alias("singletons"),
        few.alias("few_samples"),
        percent(few, _rows(), 1).alias("percent_few"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
    ).withColumn("top_5_sum", F.coalesce(top_5, F.lit(0)))
    share = percent(F.col("top_5_sum"), F.col("total"), 1)
    return sums.select(
        "unique_species", "singletons", "few_samples", "percent_few", "top_5_sum", "total", share.alias("percent_top_5")
    )


def describe_by_species(df: DataFrame, col: str, by: str = "species_name") -> DataFrame:
    """count, mean, std, min, quartiles, max of a column per species.

    Quartiles are exact (linear between ranks). They come from value counts with
    running totals, so the values of a hot species are never held by one task.
    """
    known = df.filter(F.col(by).isNotNull() & F.col(col).isNotNull()).select(by, F.col(col).cast("double").alias("_x"))
    counts = materialize(known.groupBy(by, "_x").agg(_rows().alias("_n")), "value-counts")
    # All moments come from the value counts; squares are taken around the mean, as large values would cancel.
    n, x = F.col("_n"), F.col("_x")
    sums = counts.groupBy(by).agg(
        F.sum(n).alias("count"), (F.sum(n * x) / F.sum(n)).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max")
    )
    apart = counts.join(sums.select(by, "mean"), by).groupBy(by).agg(F.sum(n * (x - F.col("mean")) ** 2).alias("_squares"))
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_squares") / (F.col("count") - 1)))
    moments = sums.join(apart, by).withColumn("std", std)
    ranked = running_totals(counts, [by], "_x", ["_n"], value_cuts(counts, "_x"), descending=False)

    def at_rank(rank: Column) -> Column:
        """Value at a 0-based rank."""
        here = (F.col("_n_run") - F.col("_n") <= rank) & (rank < F.col("_n_run"))
        return F.max(F.when(here, F.col("_x")))

    quartiles = []
    for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        pos = (F.col("_n_total") - 1) * F.lit(q)
        quartiles += [
            at_rank(F.floor(pos)).alias(f"{name}_low"),
            at_rank(F.ceil(pos)).alias(f"{name}_high"),
            F.max(pos - F.floor(pos)).alias(f"{name}_part"),
        ]
    points = ranked.groupBy(by).agg(*quartiles)
    c = F.col
    return moments.join(points, by).select(
        by, "count", "mean", "std", "min",
        *[(c(f"{p}_low") + (c(f"{p}_high") - c(f"{p}_low")) * c(f"{p}_part")).alias(p) for p in ("p25", "p50", "p75")],
        "max",
    )


def other_accuracy(errors: DataFrame, other_label: int) -> DataFrame:
    """Correct and all predictions in the Other class."""
    in_other = F.col("actual_class") == other_label
    counts = errors.agg(
        F.count_if(in_other).alias("other_total"), F.count_if(in_other & F.col("is_correct")).alias("other_correct")
    )
    return counts.withColumn("other_accuracy", ratio(F.col("other_correct"), F.col("other_total")))


def error_type_breakdown(errors: DataFrame, other_label: int) -> DataFrame:
    """Error types in the Other class: counts and proportions."""
    rows = errors.filter((F.col("actual_class") == other_label) & F.col("error_type").isNotNull())
    counts = rows.groupBy("error_type").agg(_rows().alias("count"))
    return counts.withColumn("proportion", F.col("count") / _total("count"))


def per_species_accuracy(errors: DataFrame, other_label: int) -> DataFrame:
    """Count and accuracy per species inside the Other class."""
    rows = errors.filter((F.col("actual_class") == other_label) & F.col("validated_frog_names").isNotNull())
    return rows.groupBy("validated_frog_names").agg(
        F.count("is_correct").alias("count"), F.avg(F.col("is_correct").cast("int")).alias("accuracy")
    )


def _confusion_columns(df: DataFrame) -> DataFrame:
    text = F.concat(F.col("cases").cast("string"), F.lit(" / "), F.col("total_cases").cast("string"))
    return df.withColumn("confusion_rate", F.col("cases") / F.col("total_cases")).withColumn("rate_cases", text)


def other_as_target_confusion(errors: DataFrame, other_label: int, class_name_of) -> DataFrame:
    """Other species taken for targets; the rate is over the misclassified rows of the species.

    ``class_name_of`` maps a label column to a name column.
    """
    rows = errors.filter((F.col("actual_class") == other_label) & (F.col("pred_class") != other_label))
    pairs = rows.filter(F.col("validated_frog_names").isNotNull()).groupBy("validated_frog_names", "pred_class").agg(
        F.count("id").alias("cases"), F.avg("pred_class_prob").alias("mean_confidence")
    )
    total = F.sum("cases").over(Window.partitionBy("validated_frog_names"))
    named = pairs.withColumn("total_cases", total).withColumn("confused_target", class_name_of(F.col("pred_class")))
    return _confusion_columns(named).orderBy(F.col("cases").desc(), "validated_frog_names", "pred_class")


def target_as_other_confusion(errors: DataFrame, other_label: int, class_name_of) -> DataFrame:
    """Targets taken for Other; the rate is over all rows of the target."""
    to_other = F.col("pred_class") == other_label
    rows = errors.filter(F.col("actual_class") != other_label).groupBy("actual_class").agg(
        F.count(F.when(to_other, F.col("id"))).alias("cases"),
        F.avg(F.when(to_other, F.col("pred_class_prob"))).alias("mean_confidence"),
        F.count("id").alias("total_cases"),
        F.count_if(to_other).alias("_rows"),
    )
    named = rows.filter("_rows > 0").drop("_rows").withColumn("target_species", class_name_of(F.col("actual_class")))
    return _confusion_columns(named).orderBy(F.col("cases").desc(), "actual_class")
