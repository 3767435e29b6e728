"""Forecasts that need no model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.operators.ordered import last_rows


def weekday_means(train: DataFrame) -> DataFrame:
    return train.groupBy("stock_code", "day_of_week").agg(F.avg("quantity").alias("_weekday_mean"))


def seasonal_naive(train: DataFrame, test: DataFrame) -> DataFrame:
    """Predict the mean of the same product and weekday.

    Falls back to the product mean, then to 0. Adds ``predicted`` to ``test``.
    """
    overall = train.groupBy("stock_code").agg(F.avg("quantity").alias("_mean"))
    best = F.coalesce(F.col("_weekday_mean"), F.col("_mean"), F.lit(0.0))
    return (
        test.join(weekday_means(train), ["stock_code", "day_of_week"], "left")
        .join(overall, "stock_code", "left")
        .withColumn("predicted", F.greatest(best, F.lit(0.0)))
        .drop("_weekday_mean", "_mean")
    )


def moving_average(train: DataFrame, test: DataFrame, rows: int = 7) -> DataFrame:
    """Predict the mean of the last ``rows`` training rows of the product, else 0."""
    recent = (
        last_rows(train.select("stock_code", "date", "quantity"), "stock_code", "date", rows)
        .groupBy("stock_code")
        .agg(F.avg("quantity").alias("_recent"))
    )
    return (
        test.join(recent, "stock_code", "left")
        .withColumn("predicted", F.greatest(F.coalesce(F.col("_recent"), F.lit(0.0)), F.lit(0.0)))
        .drop("_recent")
    )
