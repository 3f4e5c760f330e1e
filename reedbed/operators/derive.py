"""Derived columns: time, species counts, labels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reedbed.config import ClassMapping, CleaningCriteria
from reedbed.functions.columns import has_any, label_of, only, species_of
from reedbed.operators.anchors import ANCHORS
from reedbed.operators.clean import clean_recordings, project_cleaned
from reedbed.sources.recordings import parse_list_columns, require_columns

# Dates and times of day accepted besides ISO text; month first where both readings are possible.
DATE_FORMATS = ("M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "yyyyMMdd", "MMM d yyyy", "d MMM yyyy")
CLOCK_FORMATS = ("[ H:mm[:ss]]", " h:mm[:ss] a")
TIME_FORMATS = tuple(date + clock for date in DATE_FORMATS for clock in CLOCK_FORMATS)


def parse_capture_time(df: DataFrame, col: str = "capture_time", formats: Sequence[str] = TIME_FORMATS) -> DataFrame:
    """Text to wall-clock time; a zone suffix is dropped, bad text gives null. A time stays as it is.

    A leading weekday, commas, long month names, dashes, years of two digits (2000 to 2099), a dot in the time of day, a time
    before the date and a year behind it are put right before the formats are tried.
    ``unparsed_times`` counts what is lost.
    """
    if dict(df.dtypes)[col] == "timestamp_ntz":
        return df
    text = F.trim(F.col(col).cast("string"))
    plain = F.trim(F.regexp_replace(F.regexp_replace(text, r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*[,.]?\s+", ""), r"[,\s]+", " "))
    plain = F.regexp_replace(plain, r"(?i)^(\d{1,2}:\d{2}(?::\d{2})?(?: ?[ap]\.?m\.?)?) (.+)$", "$2 $1")
    plain = F.regexp_replace(plain, r"(?i) (\d{1,2})\.(\d{2})( ?[ap]\.?m\.?)?$", " $1:$2$3")
    plain = F.regexp_replace(plain, r"^(\d{1,2})-(\d{1,2})-(\d{4}|\d{2})(?!\d)", "$1/$2/$3")
    plain = F.regexp_replace(plain, r"^(\d{1,2}/\d{1,2})/(\d{2})(?!\d)", "$1/20$2")
    plain = F.regexp_replace(plain, r"^(\d{4})-(\d{1,2})-(\d{1,2})", "$1/$2/$3")
    plain = F.regexp_replace(plain, r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?", "$1")
    plain = F.regexp_replace(plain, r"^(\p{L}+ \d{1,2}) (\d{1,2}:\d{2}(?::\d{2})?) (\d{4})$", "$1 $3 $2")
    plain = F.regexp_replace(plain, r"(?i)(\d) ?([ap])\.?m\.?$", "$1 $2m")
    plain = _once(plain, lambda p: F.concat(F.initcap(F.regexp_replace(p, r" [aApP]m$", "")), F.upper(F.regexp_extract(p, r"( [aApP]m)$", 1))))
    iso = text.try_cast("timestamp_ntz")
    read = _once(plain, lambda p: F.coalesce(*[F.try_to_timestamp(p, F.lit(f)).cast("timestamp_ntz") for f in formats]))
    # A bare number casts as a year; eight digits are a date.
    return df.withColumn(col, F.coalesce(F.when(~text.rlike(r"^\d+$"), iso), read, iso))


def _once(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed a single time, however often ``fn`` refers to it."""
    return F.transform(F.array(value), fn)[0]


def unparsed_times(df: DataFrame, col: str = "capture_time") -> DataFrame:
    """One row: ``unparsed``, the number of texts that are not blank and give no time."""
    given = df.select(F.col(col).alias("_text"), F.col(col).alias("_time"))
    text = F.trim(F.col("_text").cast("string"))
    return parse_capture_time(given, "_time").agg(F.count_if((text != "") & F.col("_time").isNull()).alias("unparsed"))


def sort_species(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.sort_array(c) for c in ("validated_frog_names", "validated_frog_ids")})


def temporal_features(df: DataFrame) -> DataFrame:
    """year, month, hour; null time stays null."""
    return df.withColumns({"year": F.year("capture_time"), "month": F.month("capture_time"), "hour": F.hour("capture_time")})


def species_count_features(df: DataFrame) -> DataFrame:
    """Counts come from the id list."""
    count = F.coalesce(F.size("validated_frog_ids"), F.lit(0))
    count = F.when(count < 0, 0).otherwise(count)
    return df.withColumns({"is_multi_species": count > 1, "species_count": count})


def includes_target(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    return df.withColumn("includes_target_species", has_any(F.col("validated_frog_names"), targets))


def target_species_count(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Target names with repeats; from the name list, unlike ``species_count``."""
    return df.withColumn("target_species_count", F.size(only(F.col("validated_frog_names"), targets)))


def target_species_ratio(df: DataFrame) -> DataFrame:
    share = F.when(F.col("species_count") > 0, F.col("target_species_count") / F.col("species_count"))
    return df.withColumn("target_species_ratio", F.coalesce(share, F.lit(0.0)))


def species_type(df: DataFrame) -> DataFrame:
    kind = (
        F.when(F.col("target_species_count") == 0, "Other")
        .when(F.col("target_species_count") == F.col("species_count"), "Target Only")
        .otherwise("Mixed")
    )
    return df.withColumn("species_type", kind)


def class_labels(df: DataFrame, mapping: ClassMapping) -> DataFrame:
    """Names to labels; unmapped names are dropped."""
    mapped = only(F.col("species_names"), mapping.species)
    return df.withColumn("class_labels", F.transform(mapped, lambda n: label_of(n, mapping.species)))


def multi_hot_vector(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """0/1 per target, in target order."""
    present = [F.array_contains("species_names", t).cast("int") for t in targets]
    return df.withColumn("class_label_vector", F.array(*present))


def first_species(df: DataFrame) -> DataFrame:
    """First name and id of the lists as given."""
    return df.withColumns(
        {
            "first_species_name": F.try_element_at("validated_frog_names", F.lit(1)),
            "first_species_id": F.try_element_at("validated_frog_ids", F.lit(1)),
        }
    )


def class_name(df: DataFrame, mapping: ClassMapping, label: str, out: str) -> DataFrame:
    """Label to species name; unknown labels give null."""
    return df.withColumn(out, species_of(F.col(label), mapping.species))


def label_binarize(df: DataFrame, classes: Sequence[int], label: str = "y_true") -> DataFrame:
    return df.withColumn("y_true_binarized", F.array(*[(F.col(label) == c).cast("int") for c in classes]))


def single_label(
    df: DataFrame, mapping: ClassMapping, anchor: str | Callable[[DataFrame, Sequence[str]], DataFrame] | None = None
) -> DataFrame:
    """One species and one label per recording.

    A lone species stands for itself; with more, the anchor decides, and without an
    anchor no species is chosen. A chosen target gives its label, all else the "Other"
    label if that is mapped: a multi-species row without anchor gets label 0.
    """
    anchored = df.withColumn("_anchor", F.lit(None).cast("string"))
    if anchor is not None:
        add = ANCHORS[anchor] if isinstance(anchor, str) else anchor
        anchored = add(df, mapping.species).withColumnRenamed("anchor_species", "_anchor")
    names = F.col("species_names")
    chosen = F.when(F.size(names) == 1, F.try_element_at(names, F.lit(1))).when(F.size(names) > 1, F.col("_anchor"))
    label = F.coalesce(label_of(F.col("species_name_single"), mapping.species), F.lit(mapping.other_label).cast("int"))
    return (
        anchored.withColumn("species_name_single", chosen)
        .withColumn("class_label_single", label)
        .withColumn("class_name_single", species_of(F.col("class_label_single"), mapping.species))
        .drop("_anchor")
    )


def derive_columns(df: DataFrame, mapping: ClassMapping, anchor=None) -> DataFrame:
    """All derived columns of cleaned rows, from time features to the label vector."""
    derived = df.transform(parse_capture_time).transform(sort_species).transform(temporal_features)
    derived = derived.transform(species_count_features)
    derived = derived.transform(includes_target, mapping.species).transform(target_species_count, mapping.species)
    derived = derived.transform(target_species_ratio).transform(species_type)
    derived = derived.withColumns(
        {"species_names": F.col("validated_frog_names"), "species_ids": F.col("validated_frog_ids")}
    )
    derived = derived.transform(class_labels, mapping).transform(single_label, mapping, anchor)
    return derived.transform(multi_hot_vector, mapping.species)


def cleaned_recordings(
    raw: DataFrame, mapping: ClassMapping, criteria: CleaningCriteria = CleaningCriteria(), anchor=None
) -> DataFrame:
    """Raw rows to cleaned, labelled recordings."""
    checked = parse_list_columns(require_columns(raw))
    return project_cleaned(derive_columns(clean_recordings(checked, criteria), mapping, anchor))


DASHBOARD_COLUMNS = [
    "id", "first_species_name", "first_species_id", "sorted_species_names", "sorted_species_ids",
    "includes_target_species", "species_count", "is_multi_species", "state", "capture_time",
]


def dashboard_columns(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Columns the reports read, on rows with parsed lists."""
    derived = df.transform(species_count_features).transform(first_species).transform(includes_target, targets)
    return derived.transform(parse_capture_time).withColumns(
        {
            "sorted_species_names": F.sort_array("validated_frog_names"),
            "sorted_species_ids": F.sort_array("validated_frog_ids"),
        }
    )


def dashboard_frame(raw: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Cleaned recordings in the layout of the reports."""
    cleaned = clean_recordings(parse_list_columns(raw))
    return dashboard_columns(cleaned, targets).select(*DASHBOARD_COLUMNS)
