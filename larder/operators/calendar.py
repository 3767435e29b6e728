"""Date dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from larder.config import DEFAULT_HOLIDAYS
from larder.functions.dates import calendar_columns
from larder.functions.numbers import flag

COLUMNS = (
    "date", "year", "month", "month_name", "quarter", "week_of_year", "day_of_week",
    "day_name", "day_of_month", "day_of_year", "is_weekend", "is_month_start",
    "is_month_end", "is_quarter_end", "is_holiday", "season", "is_christmas_season",
    "is_black_friday", "is_cyber_monday", "days_to_christmas", "days_to_newyear",
)


def date_span(df: DataFrame, date: str = "date") -> DataFrame:
    """First and last date of a table as one row."""
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def build_calendar(
    span: DataFrame, holidays: Sequence[str] | DataFrame = DEFAULT_HOLIDAYS
) -> DataFrame:
    """One row per day of ``span`` (first_date, last_date).

    ``holidays`` is a short list of ISO dates or a table with a ``date`` column.
    """
    days = span.select(F.explode(F.sequence("first_date", "last_date")).alias("date"))
    if isinstance(holidays, DataFrame):
        marked = holidays.select("date").distinct().withColumn("_holiday", F.lit(1))
        days = days.join(marked, "date", "left")
        is_holiday = F.coalesce(F.col("_holiday"), F.lit(0))
    else:
        is_holiday = flag(F.col("date").cast("string").isin(list(holidays)))
    columns = calendar_columns(F.col("date")) | {"is_holiday": is_holiday}
    return days.withColumns(columns).select(*COLUMNS)
