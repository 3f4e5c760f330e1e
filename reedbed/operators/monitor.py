"""Daily error of monitored predictions ``(ts, model_id, prediction, label)`` and its violation check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rmse() -> Column:
    error = F.col("prediction") - F.col("label")
    return F.sqrt(F.avg(error * error)).alias("rmse")


def daily_metric(preds: DataFrame) -> DataFrame:
    """RMSE and number of predictions per model and day."""
    day = F.to_date("ts").cast("timestamp_ntz")
    return preds.groupBy(day.alias("day"), "model_id").agg(rmse(), F.count(F.lit(1)).alias("num_predictions"))


def metric_violation(daily: DataFrame, threshold: float = 100.0, n_eval: int = 5, n_viol: int = 2) -> DataFrame:
    """Per model: violated when ``n_viol`` of the last ``n_eval`` windows exceed the threshold."""
    latest = Window.partitionBy("model_id").orderBy(F.col("day").desc())
    recent = daily.withColumn("_rn", F.row_number().over(latest)).filter(F.col("_rn") <= n_eval)
    over = F.count_if(F.col("rmse") > threshold)
    return recent.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("windows"), over.alias("violations"), (over >= n_viol).alias("is_violated")
    )
