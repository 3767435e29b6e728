"""Forecasts for future dates."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.config import ForecastRules
from larder.functions.dates import FORECAST_DATE_PARTS, calendar_columns
from larder.functions.numbers import let
from larder.operators.baselines import seasonal_naive
from larder.operators.models import model_input, predict
from larder.operators.ordered import latest_per_key
from larder.plans.lineage import pin


def date_parts(day: Column) -> dict[str, Column]:
    columns = calendar_columns(day)
    return {name: columns[name] for name in FORECAST_DATE_PARTS}


def future_grid(products: DataFrame, first: Column, days: int) -> DataFrame:
    """Every row repeated for ``days`` dates from ``first``; no join."""
    dates = F.sequence(first, F.date_add(first, days - 1))
    return products.withColumn("date", F.explode(dates))


def forecast_next_days(
    history: DataFrame, model: PipelineModel, rules: ForecastRules = ForecastRules()
) -> DataFrame:
    """Recursive forecast: each day's prediction is the next day's lag 1.

    All other features stay at the product's last row; only six date parts and
    ``quantity_lag1`` change. One row per product goes from day to day and
    collects its predictions, so no step shuffles. The plan grows with each
    step and is cut in shared storage every few.
    """
    newest = history.agg(F.max("date")).scalar()
    names = model.stages[0].getInputCols()
    present = [c for c in dict.fromkeys(["quantity", *names]) if c in history.columns]
    latest = latest_per_key(
        history.select("stock_code", "date", *present), "stock_code", "date", present
    )
    state = pin(
        model_input(latest, names).withColumns(
            {"_start": newest, "_path": F.array().cast("array<double>")}
        )
    )
    for step in range(1, rules.horizon + 1):
        parts = date_parts(F.date_add("_start", step))
        fresh = {n: c.cast("double") for n, c in parts.items() if n in names}
        value = F.greatest(F.col("prediction"), F.lit(0.0))
        carried = {"_path": F.concat("_path", F.array(value))}
        if "quantity_lag1" in names:
            carried["quantity_lag1"] = value
        state = (
            model.transform(state.withColumns(fresh))
            .withColumns(carried)
            .drop("inputs", "prediction")
        )
        if step % rules.checkpoint_every == 0 and step < rules.horizon:
            state = pin(state)
    return state.select(
        "stock_code", "_start", F.posexplode("_path").alias("_step", "forecast_quantity")
    ).select(
        "stock_code", F.date_add("_start", F.col("_step") + 1).alias("date"), "forecast_quantity"
    )


def naive_next_days(history: DataFrame, horizon: int = 28) -> DataFrame:
    """The seasonal naive forecast for the days after the last one."""
    newest = history.agg(F.max("date")).scalar()
    codes = history.select("stock_code").distinct()
    grid = future_grid(codes, F.date_add(newest, 1), horizon)
    grid = grid.withColumn("day_of_week", F.weekday("date"))
    return seasonal_naive(history, grid).select(
        "stock_code", "date", F.col("predicted").alias("forecast_quantity")
    )


def check_request(
    codes: Sequence[str],
    start: dt.date,
    end: dt.date,
    most_days: int | None = None,
    most_products: int | None = None,
) -> list[str]:
    """Validate an ad-hoc request and drop repeated codes, keeping their order.

    The limits are for services that want them; without them any request is answered.
    """
    unique = list(dict.fromkeys(codes))
    if end < start:
        raise ValueError("end date lies before start date")
    if not unique:
        raise ValueError("no stock codes given")
    if most_days is not None and len(unique) == 1 and (end - start).days > most_days:
        raise ValueError(f"a single product is limited to {most_days} days")
    if most_products is not None and len(codes) > most_products:
        raise ValueError(f"at most {most_products} products per request")
    return unique


def request_rows(
    features: DataFrame, codes: Sequence[str], start: dt.date, end: dt.date
) -> DataFrame:
    """Feature rows for the asked products and dates.

    The latest row of each known product is repeated with fresh date parts.
    Unknown products are left out, unless none is known: then all get rows
    with date parts only.
    """
    days = (end - start).days + 1
    asked = features.sparkSession.createDataFrame([(c,) for c in codes], "stock_code string")
    known = features.join(asked, "stock_code", "left_semi")
    if known.isEmpty():
        seed = asked
    else:
        seed = latest_per_key(known, "stock_code", "date").drop("date")
    grid = future_grid(seed, F.lit(start), days)
    return grid.withColumns(date_parts(F.col("date"))).withColumn("quantity", F.lit(0.0))


def predict_range(
    features: DataFrame,
    model: PipelineModel | None,
    codes: Sequence[str],
    start: dt.date,
    end: dt.date,
) -> DataFrame:
    """Daily forecast for some products over any date range, to 4 places.

    Without a model the seasonal naive forecast answers.
    """
    rows = request_rows(features, check_request(codes, start, end), start, end)
    if model is None:
        scored = seasonal_naive(features, rows.select("stock_code", "date", "day_of_week"))
        scored = scored.withColumnRenamed("predicted", "predicted_quantity")
    else:
        scored = predict(rows, model)
    return scored.select(
        "stock_code", "date",
        F.round("predicted_quantity", 4).alias("forecast_quantity"),
    )


# Trend and seasonality per product -------------------------------------------

#: Fourier pairs by their period in days.
SEASONS = ((7.0, 3), (365.25, 5))
_RIDGE = 1e-3


def seasonal_terms(day: Column) -> list[Column]:
    """Intercept, trend, three weekly and five yearly Fourier pairs of a day number."""
    terms = [F.lit(1.0), day / 365.0]
    for period, pairs in SEASONS:
        for k in range(1, pairs + 1):
            angle = day * (2 * math.pi * k / period)
            terms += [F.sin(angle), F.cos(angle)]
    return terms


def normal_equations(terms: list[str], target: str) -> Column:
    """Aggregate: the rows of the least-squares system with its right side, as sums of products of columns."""
    sums = {(i, j): F.sum(F.col(a) * F.col(b)) for i, a in enumerate(terms) for j, b in enumerate(terms) if i <= j}
    ridge = lambda i, j: sums[min(i, j), max(i, j)] + (_RIDGE if i == j else 0.0)
    return F.array(*[
        F.array(*[ridge(i, j) for j in range(len(terms))], F.sum(F.col(a) * F.col(target))) for i, a in enumerate(terms)
    ])


def solved(system: Column, size: int) -> Column:
    """The solution of a positive definite system of ``size`` rows with its right side, by elimination.

    A step scales the pivot's row and takes it out of all others; such a system needs no
    other choice of pivots.
    """

    def step(rows: Column, j: Column) -> Column:
        scaled = lambda row: F.transform(row, lambda x: x / F.get(row, j))
        clear = lambda row, pivot: F.zip_with(row, pivot, lambda x, p: x - F.get(row, j) * p)
        return let(scaled(F.get(rows, j)), lambda pivot: F.transform(
            rows, lambda row, i: F.when(i == j, pivot).otherwise(clear(row, pivot))))

    rows = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), system, step)
    return F.transform(rows, lambda row: F.get(row, F.lit(size)))


def trend_seasonal(sales: DataFrame, horizon: int = 28, min_rows: int = 30) -> DataFrame:
    """Hold out the last ``horizon`` days of each product and predict them; no Python runs.

    Least squares on trend, weekly and yearly terms: the normal equations of all products
    are grouped sums, solved by array functions. Too short a series gets its last day,
    with prediction 0 and an infinite WAPE. A product has one row per day; all steps
    share one partitioning by product. Columns: stock_code, date, actual, predicted, wape.
    """
    product = Window.partitionBy("stock_code")
    counted = sales.select("stock_code", "date", F.greatest(F.col("quantity"), F.lit(0.0)).alias("actual"), F.col("quantity").alias("_raw")).withColumns({
        "_at": F.row_number().over(product.orderBy("date")) - 1,
        "_rows": F.count("*").over(product),
        "_day": F.date_diff("date", F.min("date").over(product)),
    })
    split = F.greatest(F.lit(10), F.col("_rows") - horizon)
    short = (F.col("_rows") < min_rows) | (F.col("_rows") <= split)
    names = [f"_term{k}" for k in range(2 + 2 * sum(n for _, n in SEASONS))]
    rows = counted.withColumns({"_held": F.col("_at") >= split, "_short": short, **dict(zip(names, seasonal_terms(F.col("_day"))))})
    too_short = rows.where(F.col("_short") & (F.col("_at") == F.col("_rows") - 1)).select(
        "stock_code", "date", F.col("_raw").cast("double").alias("actual"), F.lit(0.0).alias("predicted"), F.lit(float("inf")).alias("wape")
    )
    enough = rows.where("not _short")
    systems = enough.where("not _held").groupBy("stock_code").agg(normal_equations(names, "actual").alias("_system"))
    weights = systems.select("stock_code", solved(F.col("_system"), len(names)).alias("_weights"))
    value = sum((F.get(F.col("_weights"), F.lit(k)) * F.col(name) for k, name in enumerate(names)), F.lit(0.0))
    held = enough.where("_held").join(weights, "stock_code").withColumn("predicted", F.greatest(value, F.lit(0.0)))
    missed = F.sum(F.abs(F.col("actual") - F.col("predicted"))).over(product)
    wape = F.coalesce(F.try_divide(missed, F.sum(F.abs("actual")).over(product)), F.lit(0.0))
    return held.select("stock_code", "date", "actual", "predicted", wape.alias("wape")).unionByName(too_short)
