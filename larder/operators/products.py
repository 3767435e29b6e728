"""Product master: profile, category, ABC class and supply terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.config import AbcRule
from larder.functions.text import product_category
from larder.operators.ordered import exact_median, running_total
from larder.plans.lineage import pin

TERMS = ("lead_time_days", "moq", "supplier", "warehouse", "shelf_life_days")


def most_common(
    df: DataFrame, key: str, value: str, out: str, count: str | None = None
) -> DataFrame:
    """Mode per key; ties go to the smallest value. Counts before grouping by key.

    A row stands for as many values as its ``count`` column says, if one is named.
    """
    number = F.count(F.lit(1)) if count is None else F.sum(count)
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(number.alias("_n"))
    best = F.min(F.struct(-F.col("_n"), F.col(value).alias("v")))
    return counts.groupBy(key).agg(best["v"].alias(out))


def product_profile(tx: DataFrame) -> DataFrame:
    """Description, price range, totals and sale dates per product.

    Transactions are read once, into counts per product, price and description;
    all else comes from those.
    """
    counts = pin(
        tx.groupBy("stock_code", "unit_price", "description").agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("revenue").alias("revenue"),
            F.sum("quantity").alias("quantity"),
            F.min("invoice_date").alias("first_date"),
            F.max("invoice_date").alias("last_date"),
        )
    )
    totals = counts.groupBy("stock_code").agg(
        F.min("unit_price").alias("min_price"),
        F.max("unit_price").alias("max_price"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("quantity").alias("total_quantity"),
        F.min("first_date").alias("first_sale_date"),
        F.max("last_date").alias("last_sale_date"),
    )
    prices = exact_median(counts, ["stock_code"], "unit_price", "avg_unit_price", "lines")
    names = most_common(counts, "stock_code", "description", "description", "lines")
    return (
        totals.join(names, "stock_code", "left")
        .join(prices, "stock_code", "left")
        .select(
            "stock_code", "description", "avg_unit_price", "min_price", "max_price",
            "total_revenue", "total_quantity", "first_sale_date", "last_sale_date",
        )
    )


def classify_abc(
    profile: DataFrame, rule: AbcRule = AbcRule(), value: str = "total_revenue"
) -> DataFrame:
    """A/B/C by running share of revenue, largest first.

    The product that crosses a share limit falls in the lower class.
    """
    ranked = running_total(
        profile, [F.desc(value), F.asc("stock_code")], value, "_running", "_total"
    )
    share_of = lambda share: share * F.col("_total")
    return ranked.withColumn(
        "abc_class",
        F.when(F.col("_running") <= share_of(rule.a_share), "A")
        .when(F.col("_running") <= share_of(rule.b_share), "B")
        .otherwise("C"),
    ).drop("_running", "_total")


def build_product_master(
    tx: DataFrame,
    terms: DataFrame,
    reference_date: str | None = None,
    rule: AbcRule = AbcRule(),
) -> DataFrame:
    """One row per product. ``terms`` holds its supply terms by stock code.

    Product age is counted in whole days up to midnight of ``reference_date``,
    by default the day of the last sale.
    """
    profile = classify_abc(product_profile(tx), rule)
    if reference_date is None:
        newest = profile.agg(F.to_date(F.max("last_sale_date"))).scalar()
    else:
        newest = F.to_date(F.lit(reference_date))
    age = (
        F.unix_timestamp(newest.cast("timestamp")) - F.unix_timestamp("first_sale_date")
    ) / 86400
    return (
        profile.withColumn("category", product_category(F.col("description"), F.col("stock_code")))
        .withColumn("days_since_launch", F.floor(age).cast("int"))
        .join(terms.select("stock_code", *TERMS), "stock_code", "left")
        .select(
            "stock_code", "description", "avg_unit_price", "min_price", "max_price",
            "total_revenue", "total_quantity", "first_sale_date", "last_sale_date",
            "category", "lead_time_days", "moq", "abc_class", "days_since_launch",
            "supplier", "warehouse", "shelf_life_days",
        )
    )


def demand_steadiness(sales: DataFrame, x_below: float = 0.5, y_below: float = 1.0) -> DataFrame:
    """Per product: the variation coefficient of its monthly demand, its class X, Y or Z by it, and its quantity.

    A product without demand, or of one month, has no coefficient and is in Z.
    """
    monthly = sales.groupBy("stock_code", F.trunc("date", "month").alias("_month")).agg(F.sum("quantity").alias("quantity"))
    cv = F.try_divide(F.stddev_samp("quantity"), F.avg("quantity"))
    per_product = monthly.groupBy("stock_code").agg(cv.alias("demand_cv"), F.sum("quantity").alias("quantity"))
    steady = F.when(F.col("demand_cv") < x_below, "X").when(F.col("demand_cv") < y_below, "Y").otherwise("Z")
    return per_product.withColumn("xyz_class", steady)


def abc_xyz(sales: DataFrame, products: DataFrame) -> DataFrame:
    """The matrix of revenue class and steadiness: products, mean coefficient and quantity of each cell that has any."""
    classed = demand_steadiness(sales).join(products.select("stock_code", "abc_class"), "stock_code")
    return classed.groupBy("abc_class", "xyz_class").agg(
        F.count("*").alias("sku_count"), F.avg("demand_cv").alias("mean_cv"), F.sum("quantity").alias("quantity")
    )
