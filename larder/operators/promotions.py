"""What promotions do: lift against matched days, time since the last one, and the year before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Days of 52 weeks: the same weekday a year earlier.
YEAR = 364


def _day() -> Column:
    """Days since the epoch, so that a frame by range counts calendar days, not rows."""
    return F.unix_date("date")


def matched_promotions(sales: DataFrame, weeks: int = 8) -> DataFrame:
    """Each promotion day with its control: the product's last earlier day of that weekday without promotion.

    A control is at most ``weeks`` back; promotion days without one are left out. The
    frame goes by calendar days, so missing days are no matter. A group is one product
    and weekday. Adds ``control_date`` and ``control_quantity``.
    """
    same_day = Window.partitionBy("stock_code", F.weekday("date")).orderBy("_day").rangeBetween(-7 * weeks, -1)
    control = F.last(F.when(F.col("is_promotion") == 0, F.struct("date", "quantity")), ignorenulls=True).over(same_day)
    return (
        sales.select("stock_code", "date", "quantity", "is_promotion", _day().alias("_day"))
        .withColumn("_control", control)
        .where((F.col("is_promotion") == 1) & F.col("_control").isNotNull())
        .select(
            "stock_code", "date", "quantity", F.col("_control.date").alias("control_date"),
            F.col("_control.quantity").alias("control_quantity"),
        )
    )


def promotion_lift(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Mean difference between promotion days and their controls, its standard error, and both means."""
    difference = F.col("quantity") - F.col("control_quantity")
    return matches.groupBy(*keys).agg(
        F.count("*").alias("promotion_days"), F.avg("quantity").alias("promoted_mean"),
        F.avg("control_quantity").alias("control_mean"), F.avg(difference).alias("lift"),
        (F.stddev_samp(difference) / F.sqrt(F.count("*"))).alias("lift_error"),
        (F.try_divide(F.avg(difference), F.avg("control_quantity")) * 100).alias("lift_pct"),
    )


def calendar_features(daily: DataFrame) -> DataFrame:
    """Weeks since the last earlier promotion, and demand 52 weeks before, on days that may have gaps.

    ``quantity_lag_52w`` is the quantity 364 days earlier, null if that day has no row;
    ``quantity_mean_52w`` the mean of the rows in the week around it. Frames go by
    calendar days. A group is one product, one row per day.
    """
    series = Window.partitionBy("stock_code").orderBy("_day")
    promoted = F.max(F.when(F.col("is_promotion") == 1, F.col("_day"))).over(series.rangeBetween(Window.unboundedPreceding, -1))
    return (
        daily.withColumn("_day", _day())
        .withColumns({
            "_promoted": promoted,
            "quantity_lag_52w": F.first("quantity").over(series.rangeBetween(-YEAR, -YEAR)),
            "quantity_mean_52w": F.avg("quantity").over(series.rangeBetween(-YEAR - 3, -YEAR + 3)),
        })
        .withColumn("weeks_since_promotion", F.floor((F.col("_day") - F.col("_promoted")) / 7).cast("int"))
        .drop("_day", "_promoted")
    )
