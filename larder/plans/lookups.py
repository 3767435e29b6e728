"""Filtered reads of the result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.config import RISK_LEVELS
from larder.operators.risk import by_priority


def _is(column: str, value: str | None) -> Column:
    """Equality with the stored spelling, which the scan can use; no value means no filter.

    Codes and classes are stored in upper case, risk levels as in ``RISK_LEVELS``.
    """
    if value is None:
        return F.lit(True)
    spelling = {level.lower(): level for level in RISK_LEVELS}
    return F.col(column) == spelling.get(value.lower(), value.upper())


def find_forecast(forecast: DataFrame, stock_code: str | None = None) -> DataFrame:
    return forecast.where(_is("stock_code", stock_code))


def find_risk(
    risk: DataFrame, risk_level: str | None = None, abc_class: str | None = None
) -> DataFrame:
    return risk.where(_is("risk_level", risk_level) & _is("abc_class", abc_class))


def filter_risk(
    risk: DataFrame,
    category: str | None = None,
    risk_level: str | None = None,
    coverage: tuple[float, float] | None = None,
    price: tuple[float, float] | None = None,
) -> DataFrame:
    """Dashboard filters; ranges include both ends."""
    conditions = []
    if category is not None:
        conditions.append(F.col("category") == category)
    if risk_level is not None:
        conditions.append(F.col("risk_level") == risk_level)
    if coverage is not None:
        conditions.append(F.col("coverage_days").between(*coverage))
    if price is not None:
        conditions.append(F.col("avg_unit_price").between(*price))
    for condition in conditions:
        risk = risk.where(condition)
    return risk


def top_recommendations(
    risk: DataFrame,
    n: int = 20,
    risk_level: str | None = None,
    abc_class: str | None = None,
    most: int | None = None,
) -> DataFrame:
    """The ``n`` most urgent products after filtering, ranked from 1.

    ``matching_skus`` counts all products that pass the filters. A service may
    refuse a larger ``n`` than ``most``.
    """
    if n < 1 or (most is not None and n > most):
        raise ValueError("n must be at least 1" + (f" and at most {most}" if most else ""))
    matching = find_risk(risk, risk_level, abc_class)
    # n rows reach the ranking window.
    best = by_priority(matching).limit(n)
    rank = F.row_number().over(Window.orderBy(F.desc("priority_score"), "stock_code"))
    rounded = lambda c: F.round(c, 4).alias(c)
    return best.select(
        rank.alias("rank"), "stock_code", "description", "abc_class", "risk_level",
        rounded("risk_score"), rounded("priority_score"), "recommendation",
        rounded("revenue_at_risk"), rounded("capital_locked"), rounded("coverage_days"),
        rounded("avg_daily_demand"),
        matching.agg(F.count(F.lit(1))).scalar().alias("matching_skus"),
    )
