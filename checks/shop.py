"""The library's tables over one folder of the benchmark schema, built on first use.

As after a run of the whole chain, the stage tables (daily sales, products,
stock ledger, feature history, model rows) are written once per session and
folder, and every query reads them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.operators.calendar import build_calendar, date_span
from larder.operators.daily import build_sales_daily, daily_sales, flag_promotions
from larder.operators.features import finish_features, history_features
from larder.operators.folds import recent_history, with_min_history
from larder.operators.ordered import latest_per_key
from larder.operators.products import build_product_master
from larder.operators.risk import assess_risk, business_impact
from larder.operators.stock import project_stock
from larder.plans import reports
from larder.plans.lineage import pin
from larder.sources import tpch


_OPEN: dict[tuple[str, str], "Shop"] = {}


def shop_for(spark: SparkSession, folder: str) -> Shop:
    """The tables of a folder, shared by all queries of a Spark application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Shop(spark, folder)
    return _OPEN[key]


class Shop:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return tpch.table(self.spark, self.folder, name)

    @cached_property
    def raw(self) -> DataFrame:
        return tpch.invoice_lines(self.spark, self.folder)

    @cached_property
    def tx(self) -> DataFrame:
        """Clean transactions without buyers, which most steps do not need.

        An invoice has one buyer, so rows that differ do so without these columns.
        """
        return self.buyer_tx.drop("customer_id", "country")

    @cached_property
    def buyer_tx(self) -> DataFrame:
        return pin(tpch.transactions(self.spark, self.folder))

    @cached_property
    def terms(self) -> DataFrame:
        return tpch.supply_terms(self.spark, self.folder)

    @cached_property
    def daily(self) -> DataFrame:
        return daily_sales(self.tx)

    @cached_property
    def flagged(self) -> DataFrame:
        return flag_promotions(self.daily)

    @cached_property
    def span(self) -> DataFrame:
        return date_span(self.tx)

    @cached_property
    def sales(self) -> DataFrame:
        return pin(build_sales_daily(self.buyer_tx, span=self.span))

    @cached_property
    def calendar(self) -> DataFrame:
        return build_calendar(self.span, tpch.holidays(self.span))

    @cached_property
    def products(self) -> DataFrame:
        return pin(build_product_master(self.tx, self.terms))

    @cached_property
    def stock(self) -> DataFrame:
        return pin(project_stock(self.sales, self.products))

    @cached_property
    def latest_stock(self) -> DataFrame:
        return latest_per_key(self.stock, "stock_code", "date")

    @cached_property
    def history(self) -> DataFrame:
        return pin(history_features(self.sales))

    @cached_property
    def features(self) -> DataFrame:
        return finish_features(self.history, self.products, self.calendar, self.stock)

    @cached_property
    def model_table(self) -> DataFrame:
        return pin(with_min_history(recent_history(self.features)))

    @cached_property
    def demand_history(self) -> DataFrame:
        """The history features that risk scoring reads."""
        return self.history.select(
            "stock_code", "date", "quantity", "revenue", "unit_price", "demand_momentum"
        )

    @cached_property
    def risk(self) -> DataFrame:
        return assess_risk(self.demand_history, self.stock, self.products)

    @cached_property
    def impact(self) -> DataFrame:
        return business_impact(self.risk)

    @cached_property
    def by_day(self) -> DataFrame:
        return reports.sales_by_day(self.sales)

    @cached_property
    def by_product(self) -> DataFrame:
        return reports.sales_by_product(self.sales)

    @cached_property
    def sales_with_weekday(self) -> DataFrame:
        return self.sales.select(
            "stock_code", "date", "quantity", F.weekday("date").alias("day_of_week")
        )
