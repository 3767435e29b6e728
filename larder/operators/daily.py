"""Daily sales per product: aggregation, promotion flag and gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from larder.config import PromotionRule
from larder.functions.numbers import flag


def daily_sales(tx: DataFrame) -> DataFrame:
    """Sums, mean price and distinct orders/customers per product and day.

    Distinct values travel as rows of product, day and value only, without the
    sums, and are spread by their value before they merge, so a product-day
    holding a large share of the lines is still spread out. ``tx`` is read once
    for the sums and once for each counted column.
    """
    key = ("stock_code", "date")
    orders, customers = "invoice_no", "customer_id" if "customer_id" in tx.columns else "invoice_no"
    rows = tx.select(*key, "quantity", "revenue", "unit_price")
    for value in dict.fromkeys((orders, customers)):
        once = tx.select(*key, value).where(F.col(value).isNotNull()).distinct()
        rows = rows.unionByName(
            once.select(*key, F.lit(1).alias(f"_{value}")), allowMissingColumns=True
        )
    return rows.groupBy(*key).agg(
        F.sum("quantity").alias("quantity"),
        F.sum("revenue").alias("revenue"),
        F.avg("unit_price").alias("avg_unit_price"),
        F.count(f"_{orders}").alias("num_orders"),
        F.count(f"_{customers}").alias("num_customers"),
    )


def flag_promotions(daily: DataFrame, rule: PromotionRule = PromotionRule()) -> DataFrame:
    """Mark sale days priced well below the mean of the earlier sale days."""
    earlier = (
        Window.partitionBy("stock_code")
        .orderBy("date")
        .rowsBetween(-rule.earlier_sale_days, -1)
    )
    usual = F.avg("avg_unit_price").over(earlier)
    known = F.count("avg_unit_price").over(earlier) >= rule.min_sale_days
    return daily.withColumn(
        "is_promotion", flag(known & (F.col("avg_unit_price") < rule.price_ratio * usual))
    )


def fill_missing_days(daily: DataFrame, span: DataFrame | None = None) -> DataFrame:
    """One row per product and day of the overall date range.

    Each sale day is stretched to the day before the next sale; the first one
    also reaches back to the start of the range and the last one on to its end.
    So missing days, forward-filled and back-filled prices come from one pass
    over the sale days, without a product-by-date cross join. Filled days sell
    nothing, and revenue is quantity times the (filled) mean price.

    ``span`` is a one-row table (first_date, last_date); by default it is read
    from ``daily``.
    """
    if span is None:
        span = daily.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    series = Window.partitionBy("stock_code").orderBy("date")
    first = F.when(
        F.lag("date").over(series).isNull(), span.select("first_date").scalar()
    ).otherwise(F.col("date"))
    last = F.coalesce(
        F.date_sub(F.lead("date").over(series), 1), span.select("last_date").scalar()
    )
    stretched = daily.withColumns({"_from": first, "_to": last}).select(
        *daily.columns, F.explode(F.sequence("_from", "_to")).alias("_day")
    )

    sold = F.col("_day") == F.col("date")
    quantity = F.when(sold, F.col("quantity")).otherwise(0.0)
    return stretched.select(
        "stock_code",
        F.col("_day").alias("date"),
        quantity.alias("quantity"),
        (quantity * F.col("avg_unit_price")).alias("revenue"),
        "avg_unit_price",
        F.when(sold, F.col("num_orders")).otherwise(0).alias("num_orders"),
        F.when(sold, F.col("num_customers")).otherwise(0).alias("num_customers"),
        F.when(sold, F.col("is_promotion")).otherwise(0).alias("is_promotion"),
    )


def build_sales_daily(
    tx: DataFrame, rule: PromotionRule = PromotionRule(), span: DataFrame | None = None
) -> DataFrame:
    """Clean transactions to the dense daily table."""
    return fill_missing_days(flag_promotions(daily_sales(tx), rule), span)
