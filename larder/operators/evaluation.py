"""Forecast accuracy, model ranking and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from larder.functions.numbers import half_even
from larder.operators.ordered import exact_median, last_rows

METRICS = ("WAPE", "MAPE", "MAE", "RMSE", "Bias")
_SMALLEST_ACTUAL = 1e-8


def forecast_metrics(predictions: DataFrame, keys: list[str], median: bool = True) -> DataFrame:
    """Accuracy per key from columns ``actual`` and ``predicted``, to 4 places.

    Percentage errors leave out actuals that are not positive. WAPE is 0 when
    the actuals sum to 0. All but MdAPE come from one partial aggregation.
    """
    actual, predicted = F.col("actual"), F.col("predicted")
    error = predicted - actual
    share = F.when(actual > _SMALLEST_ACTUAL, F.abs(error / actual))
    size = F.sum(F.abs(actual))
    wape = F.when(size == 0, 0.0).otherwise(F.try_divide(F.sum(F.abs(error)), size))
    result = predictions.groupBy(*keys).agg(
        half_even(wape * 100, 4).alias("WAPE"),
        half_even(F.coalesce(F.avg(share), F.lit(0.0)) * 100, 4).alias("MAPE"),
        half_even(F.avg(F.abs(error)), 4).alias("MAE"),
        half_even(F.sqrt(F.avg(error * error)), 4).alias("RMSE"),
        half_even(F.avg(error), 4).alias("Bias"),
    )
    if not median:
        return result
    shares = predictions.select(*keys, share.alias("_share"))
    medians = exact_median(shares, keys, "_share", "_median")
    joined = result.join(medians, keys, "left")
    median_share = F.coalesce(F.col("_median"), F.lit(0.0))
    return joined.withColumn("MdAPE", half_even(median_share * 100, 4)).drop("_median")


def rank_models(per_fold: DataFrame) -> DataFrame:
    """Mean metrics per model over its folds, ranked by WAPE.

    One row per model, so the ranking window is small by construction.
    """
    means = per_fold.groupBy("model").agg(*[half_even(F.avg(m), 4).alias(m) for m in METRICS])
    best_first = Window.orderBy("WAPE", "model")
    return means.withColumn("rank", F.row_number().over(best_first))


def best_model(comparison: DataFrame, metric: str = "WAPE") -> DataFrame:
    """Name and metric of the model with the lowest metric; ties go by name."""
    lowest = F.min(F.struct(F.col(metric).alias("m"), F.col("model").alias("name")))
    return comparison.agg(lowest.alias("_best")).select(
        F.col("_best.name").alias("model"), F.col("_best.m").alias(metric)
    )


def backtest_rows(history: DataFrame, forecast: DataFrame, rows: int = 30) -> DataFrame:
    """Forecast against the last ``rows`` actual rows per product, where dates meet."""
    recent = last_actuals(history, rows)
    error = F.col("forecast_quantity") - F.col("quantity")
    return recent.join(forecast, ["stock_code", "date"]).select(
        "stock_code", "date", "quantity", "forecast_quantity",
        error.alias("error"),
        F.abs(error).alias("abs_error"),
        (F.abs(error) / F.greatest(F.col("quantity"), F.lit(0.1)) * 100).alias("pct_error"),
    )


def last_actuals(history: DataFrame, rows: int) -> DataFrame:
    return last_rows(history.select("stock_code", "date", "quantity"), "stock_code", "date", rows)


def backtest_summary(errors: DataFrame) -> DataFrame:
    return errors.agg(
        F.avg("error").alias("bias"),
        F.stddev_samp("error").alias("std_error"),
        F.avg("abs_error").alias("mae"),
        F.count(F.lit(1)).alias("n"),
    )
