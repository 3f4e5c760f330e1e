"""Stored tables are named by path or by catalog name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _is_path(table: str) -> bool:
    return "/" in table


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table) if _is_path(table) else spark.table(table)


def write_table(df: DataFrame, table: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """Paths hold Parquet; a table of the catalog keeps its own format and layout."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _is_path(table):
        writer.format("parquet").save(table)
    elif df.sparkSession.catalog.tableExists(table):
        detail = df.sparkSession.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Provider'").first()
        writer.format(detail["data_type"] if detail else "parquet").saveAsTable(table)
    else:
        writer.format("parquet").saveAsTable(table)


def layout_of(spark: SparkSession, table: str) -> list[str] | None:
    """The columns of a stored table; None before the first write."""
    if not _is_path(table):
        return spark.table(table).columns if spark.catalog.tableExists(table) else None
    try:
        return spark.read.parquet(table).columns
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_or_empty(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """The table in the given layout; no rows before the first write."""
    if not _is_path(table):
        return spark.table(table) if spark.catalog.tableExists(table) else spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(table)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
