"""Calendar attributes as expressions over a date column."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from larder.functions.numbers import flag


def weekday(day: Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(day)


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .otherwise("autumn")
    )


def is_black_friday(day: Column) -> Column:
    """The fourth Friday of November."""
    return (F.month(day) == 11) & (weekday(day) == 4) & F.dayofmonth(day).between(22, 28)


def is_cyber_monday(day: Column) -> Column:
    """Three days after Black Friday, provided that is still in November."""
    return (F.month(day) == 11) & is_black_friday(F.date_sub(day, 3))


def days_until(day: Column, target: Column) -> Column:
    return F.greatest(F.datediff(target, day), F.lit(0))


def calendar_columns(day: Column) -> dict[str, Column]:
    """Every date attribute except the holiday flag, in table order."""
    year, month = F.year(day), F.month(day)
    month_end = F.last_day(day) == day
    return {
        "year": year,
        "month": month,
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "week_of_year": F.weekofyear(day),
        "day_of_week": weekday(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "is_weekend": flag(weekday(day) >= 5),
        "is_month_start": flag(F.dayofmonth(day) == 1),
        "is_month_end": flag(month_end),
        "is_quarter_end": flag(month_end & (month % 3 == 0)),
        "season": season(month),
        "is_christmas_season": flag(month >= 11),
        "is_black_friday": flag(is_black_friday(day)),
        "is_cyber_monday": flag(is_cyber_monday(day)),
        "days_to_christmas": days_until(day, F.make_date(year, F.lit(12), F.lit(25))),
        "days_to_newyear": days_until(
            day, F.make_date(year + F.when(month >= 11, 1).otherwise(0), F.lit(1), F.lit(1))
        ),
    }


# The six date parts a forecast row refreshes for each future day.
FORECAST_DATE_PARTS = (
    "day_of_week", "day_of_month", "month", "week_of_year", "day_of_year", "is_weekend",
)


def fourier(position: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle."""
    angle = position * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)
