"""Prediction intervals by split-conformal residuals, their coverage, and SMAPE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder.operators.baselines import seasonal_naive
from larder.operators.ranks import values_at_ranks

#: Decimals to which predictions count, so that a band's edge doesn't hang on the order of a sum.
PLACES = 6


def _residual() -> Column:
    return F.round(F.abs(F.col("actual") - F.col("predicted")), PLACES)


def conformal_radius(calibration: DataFrame, keys: list[str], level: float = 0.9) -> DataFrame:
    """Per key the radius that ``level`` of new residuals stay within, and the residuals behind it.

    It is the residual of rank ceil((n + 1) * level), the largest one if there are too
    few. ``calibration`` has ``actual`` and ``predicted`` of days that the forecast
    hasn't seen, and is read several times. Keys without residuals have no row.
    """
    residuals = calibration.select(*keys, _residual().alias("radius")).where("radius is not null")
    rank = lambda n: F.array(F.least(F.ceil((n + 1) * F.lit(level)), n).cast("long"))
    sizes = residuals.groupBy(*keys).agg(F.count("*").alias("residuals"))
    return values_at_ranks(residuals, keys, "radius", rank).drop("rank").join(sizes, keys)


def with_band(predictions: DataFrame, radius: DataFrame, keys: list[str]) -> DataFrame:
    """``predictions`` with ``lower`` (0 at least) and ``upper``; null for keys without a radius."""
    known = predictions.join(radius.select(*keys, "radius"), keys, "left")
    return known.withColumns({
        "lower": F.when(F.col("radius").isNotNull(), F.greatest(F.col("predicted") - F.col("radius"), F.lit(0.0))),
        "upper": F.col("predicted") + F.col("radius"),
    })


def smape() -> Column:
    """Symmetric percentage error of an aggregate's rows; a row of two zeros counts as right."""
    size = F.abs("actual") + F.abs("predicted")
    return F.avg(F.when(size == 0, 0.0).otherwise(2 * F.abs(F.col("actual") - F.col("predicted")) / size)) * 100


def interval_report(banded: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: rows, the share of them inside the band in percent, its mean radius, and SMAPE.

    Demand is never negative, so cutting the band at 0 takes nothing from it.
    """
    inside = _residual() <= F.col("radius")
    return banded.groupBy(*keys).agg(
        F.count("radius").alias("banded_rows"), (F.avg(inside.cast("double")) * 100).alias("coverage_pct"),
        F.avg("radius").alias("mean_radius"), smape().alias("SMAPE"),
    )


def _fold(sales: DataFrame, start: Column, end: Column) -> DataFrame:
    """Seasonal-naive predictions of the days from ``start`` to ``end``, from all days before."""
    rows = sales.select("stock_code", "date", "quantity", F.weekday("date").alias("day_of_week"))
    test = rows.where((F.col("date") >= start) & (F.col("date") <= end))
    predicted = seasonal_naive(rows.where(F.col("date") < start), test)
    return predicted.select(
        "stock_code", "date", (F.date_diff("date", start) + 1).alias("step"), F.col("quantity").alias("actual"),
        F.round("predicted", PLACES).alias("predicted"),
    )


def split_folds(sales: DataFrame, horizon: int = 28) -> tuple[DataFrame, DataFrame]:
    """Predictions of the calibration days and of the held-out days, the last ``horizon``; each from all days before.

    ``sales`` has a row for each day.
    """
    last = sales.agg(F.max("date")).scalar()
    held_out = _fold(sales, F.date_sub(last, horizon - 1), last)
    calibration = _fold(sales, F.date_sub(last, 2 * horizon - 1), F.date_sub(last, horizon))
    return calibration, held_out
