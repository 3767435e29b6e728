"""Summary tables over the stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from larder.config import RISK_LEVELS, WEEKDAYS
from larder.operators.ordered import bucket_counts, exact_median
from larder.operators.risk import by_priority


# Sales ------------------------------------------------------------------------

def sales_by_day(sales: DataFrame) -> DataFrame:
    """Totals per day; every product has a row on every day."""
    return sales.groupBy("date").agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum("revenue").alias("total_revenue"),
        F.count(F.lit(1)).alias("sku_count"),
        F.sum("is_promotion").alias("promo_days"),
    )


def sales_by_week(by_day: DataFrame, days: int = 365) -> DataFrame:
    """Monday weeks over the last ``days`` days; the first week may be partial."""
    newest = by_day.agg(F.max("date")).scalar()
    recent = by_day.where(F.col("date") >= F.date_sub(newest, days))
    return recent.groupBy(F.to_date(F.date_trunc("week", "date")).alias("week")).agg(
        F.sum("total_quantity").alias("quantity"), F.sum("total_revenue").alias("revenue")
    )


def sales_by_product(sales: DataFrame) -> DataFrame:
    """Totals per product. Revenue is summed as decimals, so no order of summation shows."""
    return sales.groupBy("stock_code").agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum(F.round("revenue", 6).cast("decimal(28,6)")).cast("double").alias("total_revenue"),
        F.avg("avg_unit_price").alias("avg_price"),
        F.max(F.when(F.col("quantity") > 0, F.col("date"))).alias("last_sale"),
        F.min(F.when(F.col("quantity") > 0, F.col("date"))).alias("first_sale"),
    )


def sales_by_category(by_product: DataFrame, products: DataFrame) -> DataFrame:
    """Totals per category, added up per product first."""
    return (
        by_product.join(products.select("stock_code", "category"), "stock_code")
        .groupBy("category")
        .agg(
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("total_quantity").alias("total_quantity"),
            F.count(F.lit(1)).alias("sku_count"),
        )
    )


def sales_by_month(by_day: DataFrame) -> DataFrame:
    """Month of the year, all years together."""
    return by_day.groupBy(F.month("date").alias("month")).agg(
        F.sum("total_revenue").alias("revenue"),
        F.sum("total_quantity").alias("quantity"),
        F.date_format(F.min("date"), "MMM").alias("month_name"),
    )


def sales_by_weekday(by_day: DataFrame) -> DataFrame:
    """Mean units per weekday; ``position`` orders Monday first."""
    return (
        by_day.groupBy(F.weekday("date").alias("position"))
        .agg(F.avg("total_quantity").alias("avg_qty"))
        .withColumn("day", F.get(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("position")))
    )


def trend(by_day: DataFrame, value: str, averages: tuple[int, ...] = (7, 28)) -> DataFrame:
    """Daily value with trailing means. One row per day, so one ordered window is enough."""
    series = Window.orderBy("date")
    means = {
        f"ma{n}": F.avg(value).over(series.rowsBetween(-(n - 1), 0)) for n in averages
    }
    return by_day.select("date", value).withColumns(means)


def top_products(by_product: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    """Largest revenue first, with a label cut to 40 characters."""
    top = by_product.orderBy(F.desc("total_revenue"), "stock_code").limit(n)
    names = products.select("stock_code", "description", "category", "abc_class").dropDuplicates()
    label = F.coalesce(F.substring("description", 1, 40), F.col("stock_code"))
    return top.join(names, "stock_code", "left").select(
        "stock_code", label.alias("label"), "category", "abc_class",
        "total_revenue", "total_quantity",
        F.concat(F.lit("£"), F.format_number("total_revenue", 0)).alias("revenue_text"),
    )


def abc_summary(by_product: DataFrame, products: DataFrame) -> DataFrame:
    """Products, revenue and their shares per class."""
    classes = (
        by_product.join(products.select("stock_code", "abc_class", "avg_unit_price"), "stock_code")
        .groupBy("abc_class")
        .agg(
            F.count(F.lit(1)).alias("sku_count"),
            F.sum("total_revenue").alias("total_revenue"),
            F.avg("avg_unit_price").alias("avg_price"),
        )
    )
    everything = Window.partitionBy(F.lit(1))
    share = lambda c: F.round(F.col(c) / F.sum(c).over(everything) * 100, 1)
    return classes.withColumns(
        {"revenue_pct": share("total_revenue"), "sku_pct": share("sku_count")}
    )


def promotion_effect(sales: DataFrame) -> DataFrame:
    """Units on promoted and on regular product-days."""
    labelled = sales.select(
        F.when(F.col("is_promotion") == 1, "Promotion").otherwise("Regular").alias("promo"),
        "quantity",
    )
    stats = labelled.groupBy("promo").agg(
        F.avg("quantity").alias("mean"), F.sum("quantity").alias("sum")
    )
    # Two groups hold all rows, so the median must not gather a group.
    return stats.join(exact_median(labelled, ["promo"], "quantity", "median"), "promo")


def promotion_days(by_day: DataFrame) -> DataFrame:
    """Days with and without any promotion: means and share of all days."""
    labelled = by_day.withColumn(
        "label", F.when(F.col("promo_days") > 0, "Promotion").otherwise("Regular")
    )
    days = labelled.groupBy("label").agg(
        F.avg("total_quantity").alias("avg_qty"),
        F.avg("total_revenue").alias("avg_rev"),
        F.count(F.lit(1)).alias("days"),
    )
    everything = Window.partitionBy(F.lit(1))
    return days.withColumn("days_pct", F.col("days") / F.sum("days").over(everything) * 100)


def seasonality(df: DataFrame, value: str = "quantity") -> DataFrame:
    """Mean by month (rows) and weekday (columns); absent pairs are 0."""
    return (
        df.groupBy(F.month("date").alias("month"), F.date_format("date", "EEE").alias("_day"))
        .agg(F.avg(value).alias("_mean"))
        .groupBy("month")
        .pivot("_day", list(WEEKDAYS))
        .agg(F.first("_mean"))
        .fillna(0.0)
    )


def executive_kpis(by_day: DataFrame, by_product: DataFrame, products: DataFrame) -> DataFrame:
    """Headline figures in one row, from the three summary tables."""
    days = by_day.agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.avg("total_revenue").alias("avg_daily_revenue"),
        F.min(F.struct((-F.col("total_revenue")).alias("r"), "date"))["date"].alias("peak_day"),
        (F.sum("promo_days") / F.sum("sku_count") * 100).alias("promo_pct"),
    )
    a_revenue = F.sum(F.when(F.col("abc_class") == "A", F.col("total_revenue")).otherwise(0.0))
    shares = (
        by_product.select("stock_code", "total_revenue")
        .join(
            products.select("stock_code", "abc_class", "category", "lead_time_days"), "stock_code"
        )
        .agg(
            F.count(F.lit(1)).alias("total_skus"),
            (a_revenue / F.sum("total_revenue") * 100).alias("a_revenue_pct"),
            F.countDistinct("category").alias("categories"),
            F.avg("lead_time_days").alias("avg_lead_days"),
        )
    )
    return days.withColumn("_shares", shares.select(F.struct("*")).scalar()).select(
        *days.columns, "_shares.*"
    )


def calendar_kpis(calendar: DataFrame) -> DataFrame:
    return calendar.agg(
        F.count(F.lit(1)).alias("date_rows"),
        F.sum("is_holiday").alias("holidays"),
        F.sum("is_black_friday").alias("black_fridays"),
        F.sum("is_weekend").alias("weekend_days"),
    )


# Stock ------------------------------------------------------------------------

def inventory_kpis(stock: DataFrame, latest: DataFrame) -> DataFrame:
    """Value, cover, reorder events over all days, empty and low products."""
    events = stock.agg(F.sum("reorder_triggered")).scalar()
    now = latest.agg(
        F.count(F.lit(1)).alias("skus_tracked"),
        F.sum("inventory_value").alias("total_value"),
        F.avg("coverage_days").alias("avg_coverage_days"),
        F.count_if(F.col("closing_inventory") <= 0).alias("zero_stock_skus"),
        F.count_if(F.col("closing_inventory") <= F.col("reorder_point")).alias("below_reorder"),
    )
    return now.withColumn("reorder_events", events)


def dead_stock(latest: DataFrame) -> DataFrame:
    """Products by days of cover: over a year, over 90 days, the rest."""
    cover = F.col("coverage_days")
    return latest.agg(
        F.count_if(cover > 365).alias("dead"),
        F.count_if((cover > 90) & (cover <= 365)).alias("slow"),
        F.count_if(cover <= 90).alias("active"),
        F.sum(F.when(cover > 365, F.col("inventory_value")).otherwise(0.0)).alias("dead_value"),
    )


def coverage_histogram(latest: DataFrame) -> DataFrame:
    return bucket_counts(latest, "coverage_days", 0, 365, 40)


def top_overstocked(latest: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    top = latest.orderBy(F.desc("coverage_days"), "stock_code").limit(n)
    names = products.select("stock_code", "description", "category").dropDuplicates()
    return top.select(
        "stock_code", "closing_inventory", "coverage_days", "inventory_value", "reorder_point"
    ).join(names, "stock_code", "left")


# Forecast ---------------------------------------------------------------------

def forecast_summary(forecast: DataFrame, products: DataFrame) -> DataFrame:
    """Total, mean and peak per product, with revenue at the list price."""
    peak = F.min(F.struct((-F.col("forecast_quantity")).alias("q"), "date"))["date"]
    totals = forecast.groupBy("stock_code").agg(
        F.sum("forecast_quantity").alias("total_units"),
        F.avg("forecast_quantity").alias("avg_daily"),
        F.max("forecast_quantity").alias("peak_units"),
        peak.alias("peak_date"),
    )
    names = products.select(
        "stock_code", "description", "category", "abc_class", "avg_unit_price"
    ).dropDuplicates(["stock_code"])
    return (
        totals.join(names, "stock_code", "left")
        .withColumn("forecast_revenue", F.col("total_units") * F.col("avg_unit_price"))
        .drop("avg_unit_price")
    )


def forecast_with_history(
    history: DataFrame, forecast: DataFrame, code: str, rows: int = 90, band: float = 0.25
) -> DataFrame:
    """The last ``rows`` days of one product followed by its forecast and band."""
    mine = F.col("stock_code") == code
    past = (
        history.where(mine).select("date", F.col("quantity").alias("value"))
        .orderBy(F.desc("date")).limit(rows)
        .select(
            F.lit("history").alias("series"), "date", "value",
            F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"),
        )
    )
    value = F.col("forecast_quantity")
    future = forecast.where(mine).select(
        F.lit("forecast").alias("series"), "date", value.alias("value"),
        (value * (1 - band)).alias("lower"), (value * (1 + band)).alias("upper"),
    )
    return past.unionByName(future)


# Risk -------------------------------------------------------------------------

def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def decision_matrix(risk: DataFrame) -> DataFrame:
    """Products by class (rows) and risk level (columns)."""
    return (
        risk.groupBy("abc_class").pivot("risk_level", list(RISK_LEVELS))
        .agg(F.count(F.lit(1))).fillna(0)
    )


def priority_actions(risk: DataFrame, n: int = 50) -> DataFrame:
    return by_priority(risk).limit(n).select(
        "priority_score", "stock_code", "description", "category", "abc_class",
        "risk_level", "coverage_days", "revenue_at_risk", "recommendation",
    )


def recommendation_groups(risk: DataFrame, n: int = 50) -> DataFrame:
    """The first ``n`` products of each action; actions by mean priority.

    The rank limit is applied per map task, so a large group is cut before the
    shuffle.
    """
    groups = risk.groupBy("recommendation").agg(
        F.count(F.lit(1)).alias("group_skus"), F.avg("priority_score").alias("group_priority")
    )
    ranked = Window.partitionBy("recommendation").orderBy(F.desc("priority_score"), "stock_code")
    top = risk.withColumn("position", F.row_number().over(ranked)).where(F.col("position") <= n)
    return top.select(
        "recommendation", "position", "stock_code", "description", "category", "abc_class",
        "risk_score", "coverage_days", "revenue_at_risk", "capital_locked", "priority_score",
    ).join(groups, "recommendation")


def risk_histogram(risk: DataFrame) -> DataFrame:
    return bucket_counts(risk, "risk_score", 0, 100, 30)


def year_over_year(by_day: DataFrame) -> DataFrame:
    """Revenue by calendar month beside that of the same month a year before; null where there was none."""
    months = by_day.groupBy(F.trunc("date", "month").alias("month")).agg(F.sum("total_revenue").alias("revenue"))
    before = months.select(F.add_months("month", 12).alias("_month"), F.col("revenue").alias("revenue_before"))
    growth = F.try_divide(F.col("revenue") - F.col("revenue_before"), F.col("revenue_before")) * 100
    return months.join(before, F.col("month") == F.col("_month"), "left").select(
        "month", "revenue", "revenue_before", growth.alias("growth_pct")
    )
