"""Rounding and null helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def half_even(value: Column, places: int = 2) -> Column:
    """Scaled round-half-to-even, as numeric libraries round float arrays."""
    scale = float(10**places)
    return F.rint(value * scale) / scale


def half_up(value: Column) -> Column:
    """A double to the nearest whole number, ties away from zero.

    The same as ``F.round(value, 0)``, which goes through text and decimals for every
    value; this stays with doubles.
    """
    size = F.abs(value)
    whole = F.rint(size)
    # rint takes ties to the even number; adding 0.0 turns -0.0 into 0.0.
    return F.signum(value) * F.when(size - whole == 0.5, whole + 1.0).otherwise(whole) + F.lit(0.0)


def at_least(value: Column, floor: float) -> Column:
    """Lower clip that keeps nulls null (``greatest`` alone skips them)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(float(floor))))


def at_most(value: Column, ceiling: float) -> Column:
    """Upper clip that keeps nulls null."""
    return F.when(value.isNotNull(), F.least(value, F.lit(float(ceiling))))


def flag(condition: Column) -> Column:
    """0/1 integer; a null condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating column."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, floating)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
