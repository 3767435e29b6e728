"""The benchmark star schema seen as invoice lines.

Order lines play invoice lines and part names play products. Returned lines
play cancelled invoices. Prices are whole currency units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from larder.config import CleaningRules
from larder.functions.numbers import half_up
from larder.operators.cleaning import clean_transactions

# Public holidays of the fixture: the same month days in every year.
HOLIDAY_MONTH_DAYS = ("01-01", "12-25", "12-26")

RULES = CleaningRules(country=None)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _product(by_brand: bool) -> Column:
    return F.concat_ws(" ", "p_name", "p_brand") if by_brand else F.col("p_name")


def _order_buyers(spark: SparkSession, folder: str) -> tuple[DataFrame, Column, Column]:
    """Orders with their customers and nations, and the columns of customer and country."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )
    return joined, F.col("o_custkey").cast("string"), F.col("n_name")


def invoice_lines(
    spark: SparkSession, folder: str, buyers: bool = True, by_brand: bool = False
) -> DataFrame:
    """Raw lines; ``buyers=False`` saves the joins for customer and country.

    ``by_brand`` makes a product of each part name and brand: 25 times as many.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey)
    columns = {
        "invoice_no": F.concat(
            F.when(F.col("l_returnflag") == "R", "C").otherwise(""),
            F.col("l_orderkey").cast("string"),
        ),
        "stock_code": _product(by_brand),
        "description": F.col("p_name"),
        "quantity": F.col("l_quantity"),
        "invoice_date": F.col("l_shipdate").cast("timestamp"),
        "unit_price": half_up(F.col("l_extendedprice") / F.col("l_quantity")),
    }
    if buyers:
        orders, customer, country = _order_buyers(spark, folder)
        joined = joined.join(orders, joined.l_orderkey == orders.o_orderkey)
        columns |= {"customer_id": customer, "country": country}
    return joined.select(*[c.alias(n) for n, c in columns.items()])


def transactions(spark: SparkSession, folder: str, buyers: bool = True) -> DataFrame:
    """Clean transactions of the lines.

    The buyers follow from the invoice, so lines are cleaned without them. Lines
    are shuffled once, by invoice: both the row dedupe and the join of the buyers
    use that. An order that comes with several buyers gives a row for each.
    """
    raw = invoice_lines(spark, folder, buyers=False)
    if not buyers:
        return clean_transactions(raw, RULES)
    orders, customer, country = _order_buyers(spark, folder)
    bought = orders.select(
        F.col("o_orderkey").cast("string").alias("invoice_no"), customer.alias("customer_id"), country.alias("country")
    ).repartition("invoice_no").distinct()
    tx = clean_transactions(raw.repartition("invoice_no"), RULES)
    return tx.join(bought, "invoice_no").select(
        *raw.columns, "customer_id", "country", "date", "revenue"
    )


def supply_terms(spark: SparkSession, folder: str, by_brand: bool = False) -> DataFrame:
    """Supply terms by product, derived from its lowest part key."""
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    key = F.col("_key")
    terms = (
        table(spark, folder, "part")
        .groupBy(F.upper(F.trim(_product(by_brand))).alias("stock_code"))
        .agg(F.min("p_partkey").alias("_key"))
        .select(
            "stock_code",
            (F.pmod(key, F.lit(12)) + 3).cast("int").alias("lead_time_days"),
            ((F.pmod(key, F.lit(9)) + 1) * 12).cast("int").alias("moq"),
            F.pmod(key, F.lit(10)).alias("_supplier"),
            F.concat(F.lit("Warehouse_"), F.pmod(key, F.lit(4)).cast("string")).alias("warehouse"),
            (F.pmod(key * 37, F.lit(1460)) + 365).cast("int").alias("shelf_life_days"),
        )
    )
    return terms.join(suppliers, terms["_supplier"] == suppliers.s_suppkey, "left").select(
        "stock_code", "lead_time_days", "moq", F.col("s_name").alias("supplier"),
        "warehouse", "shelf_life_days",
    )


def holidays(span: DataFrame) -> DataFrame:
    """The fixture's holiday table for a date span."""
    days = span.select(F.explode(F.sequence("first_date", "last_date")).alias("date"))
    return days.where(F.date_format("date", "MM-dd").isin(list(HOLIDAY_MONTH_DAYS)))
