"""Named queries and their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its result is shown in engine-neutral form."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: shown(fn(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def shown(df: DataFrame) -> DataFrame:
    """Arrays as joined text, doubles rounded to 6 digits."""

    def column(field: T.StructField):
        col, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.ArrayType):
            fractional = isinstance(kind.elementType, (T.DoubleType, T.FloatType))
            parts = F.transform(
                col, lambda x: (x.cast("double").cast("decimal(18,6)") if fractional else x).cast("string")
            )
            return F.array_join(parts, ",").alias(field.name)
        if isinstance(kind, T.DoubleType):
            return F.round(col, 6).alias(field.name)
        return col

    return df.select(*[column(f) for f in df.schema])
