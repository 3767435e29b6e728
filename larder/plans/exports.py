"""Filtered tables for people, as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.operators.risk import by_priority
from larder.plans.lookups import filter_risk, find_forecast
from larder.sources.tables import export_csv

# --- Fixed values -----------------------------------------------------------
RISK_REPORT = (
    "stock_code", "description", "category", "abc_class", "risk_level", "risk_score",
    "coverage_days", "revenue_at_risk", "capital_locked", "priority_score", "recommendation",
)
PRIORITY_ACTIONS = (
    "priority_score", "stock_code", "description", "category", "abc_class",
    "risk_level", "coverage_days", "revenue_at_risk", "recommendation",
)
FORECAST_UNITS = "Forecast Units"
# ----------------------------------------------------------------------------


def _present(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.select(*[c for c in names if c in df.columns])


def forecast_sheet(forecast: DataFrame, stock_code: str | None = None) -> DataFrame:
    """Days and units to one decimal of one product, or of all with their codes."""
    units = F.round("forecast_quantity", 1).alias(FORECAST_UNITS)
    codes = () if stock_code is not None else ("stock_code",)
    return find_forecast(forecast, stock_code).select(*codes, F.col("date").cast("string").alias("date"), units)


def risk_sheet(risk: DataFrame, **filters) -> DataFrame:
    """The risk report after the filters of ``filter_risk``."""
    return _present(filter_risk(risk, **filters), RISK_REPORT)


def action_sheet(risk: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` products of highest priority, the first first."""
    return _present(by_priority(risk).limit(n), PRIORITY_ACTIONS)


def recommendation_sheet(risk: DataFrame, category: str | None = None) -> DataFrame:
    """All columns of the products of one category, or of all."""
    return filter_risk(risk, category=category)


def export_sheets(risk: DataFrame, forecast: DataFrame, folder: str, n: int = 50, **filters) -> list[str]:
    """Write all sheets below ``folder``; returns their paths.

    Lists of at most ``n`` rows are one file, the others as many as they need. Codes
    come out in order within a file.
    """
    sheets = {
        "forecast": (forecast_sheet(forecast).sortWithinPartitions("stock_code", "date"), False),
        "risk_scores": (risk_sheet(risk, **filters).sortWithinPartitions("stock_code"), False),
        "priority_actions": (action_sheet(risk, n), True),
        "recommendations": (recommendation_sheet(risk, filters.get("category")).sortWithinPartitions("stock_code"), False),
    }
    paths = []
    for name, (sheet, single) in sheets.items():
        paths.append(f"{folder}/{name}")
        export_csv(sheet, paths[-1], single_file=single)
    return paths
