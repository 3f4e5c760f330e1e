"""Raw recordings: CSV scan, column check, list columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reedbed.sources.quoted_csv import read_quoted_csv

RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("call_audio", T.StringType()),
        T.StructField("quality_call", T.BooleanType()),
        T.StructField("state", T.StringType()),
        T.StructField("capture_time", T.StringType()),
        T.StructField("validated_frog_ids", T.StringType()),
        T.StructField("validated_frog_names", T.StringType()),
        T.StructField("filters_readable", T.StringType()),
        T.StructField("is_duplicate", T.BooleanType()),
        T.StructField("inappropriate_content", T.BooleanType()),
        T.StructField("has_people_activity", T.BooleanType()),
        T.StructField("validator_note_public", T.StringType()),
        T.StructField("validator_note_private", T.StringType()),
        T.StructField("validated_status", T.StringType()),
    ]
)
REQUIRED_COLUMNS = RAW_SCHEMA.fieldNames()
# A quoted string, a stretch without quotes, or a lone quote.
QUOTED_OR_NOT = r""""(?:[^"\\]|\\.)*+"|'(?:[^'\\]|\\.)*+'|[^"']++|["']"""
LIST_COLUMNS = {"validated_frog_names": "array<string>", "validated_frog_ids": "array<bigint>"}


def read_recordings(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Scan a CSV export by its header; columns other than the required ones are not parsed.

    ``multi_line`` admits line breaks inside quoted notes; files are still read by byte ranges, in two passes. Quotes
    then stand around fields and doubled inside them only. Turn it off for a single pass where no field holds a line break.
    """
    header = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path).columns
    known = {f.name: f.dataType for f in RAW_SCHEMA}
    flags = [c for c in header if isinstance(known.get(c), T.BooleanType)]
    schema = T.StructType([T.StructField(c, T.StringType() if c in flags else known.get(c, T.StringType())) for c in header])
    if multi_line:
        rows = read_quoted_csv(spark, path, schema)
    else:
        rows = spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False).csv(path)
    return rows.withColumns({c: parse_flag(c) for c in flags})


def parse_flag(name: str) -> Column:
    """A flag written as true/false or as a number, in any case; empty is null, anything else an error."""
    text = F.lower(F.trim(F.col(name)))
    return (
        F.when(text.isNull() | text.isin("", "nan", "none", "null"), F.lit(None).cast("boolean"))
        .when(text.isin("true", "1", "1.0", "t", "yes"), True)
        .when(text.isin("false", "0", "0.0", "f", "no"), False)
        .otherwise(F.raise_error(F.concat(F.lit(f"{name}: not a flag: "), text)).cast("boolean"))
    )


def require_columns(df: DataFrame, cols: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Fail on missing columns, keep only the wanted ones."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*cols)


def parse_list_columns(df: DataFrame, cols: dict[str, str] = LIST_COLUMNS) -> DataFrame:
    """List text such as ``['A', 'B']`` to arrays; anything that is not a list gives null.

    Escapes and quotes follow JSON with single quotes allowed, so a name with an
    apostrophe is written in double quotes. The empty list stays an empty list. As in
    Python, ``None`` and ``nan`` are missing entries, a comma may end the list, and
    whole numbers may be written as ``1.0``.
    """

    def parsed(name: str, kind: str):
        text = F.trim(F.col(name))
        # Quoted names are kept apart, as they may hold the same words.
        plain = F.transform(
            F.regexp_extract_all(text, F.lit(QUOTED_OR_NOT), F.lit(0)),
            lambda t: F.when(t.rlike("^[\"']"), t).otherwise(F.regexp_replace(t, r"(?<![^\s\[,])(?:None|nan)(?![^\s,\]])", "null")),
        )
        list_text = F.regexp_replace(F.array_join(plain, ""), r",\s*\]$", "]")
        if kind == "array<bigint>":
            return F.when(_is_list(text), F.from_json(list_text, "array<double>").cast(kind))
        return F.when(_is_list(text), F.from_json(list_text, kind))

    return df.withColumns({c: parsed(c, kind) for c, kind in cols.items()})


def unparsed_lists(df: DataFrame, cols: dict[str, str] = LIST_COLUMNS) -> DataFrame:
    """One row with a count for each column: the texts in brackets that are no readable list, and so give null."""
    texts = df.select(*[F.col(c) for c in cols], *[F.col(c).alias(f"_text_{c}") for c in cols])
    lost = [F.count_if(_is_list(F.trim(F.col(f"_text_{c}"))) & F.col(c).isNull()).alias(c) for c in cols]
    return parse_list_columns(texts, cols).agg(*lost)


def _is_list(text: Column) -> Column:
    return text.startswith("[") & text.endswith("]")
