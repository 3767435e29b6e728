"""The whole chain, from raw lines to risk and impact, one stored table per stage."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder import schemas
from larder.config import (
    DEFAULT_HOLIDAYS, AbcRule, CleaningRules, FeatureRules, ForecastRules, PromotionRule,
    RiskRules, StockPolicy,
)
from larder.operators import evaluation, folds, forecast, models
from larder.operators.calendar import build_calendar, date_span
from larder.operators.cleaning import clean_transactions
from larder.operators.daily import build_sales_daily
from larder.operators.features import build_features
from larder.operators.ordered import latest_per_key
from larder.operators.products import build_product_master
from larder.operators.risk import assess_risk, business_impact, by_priority
from larder.operators.stock import project_stock, reorder_list
from larder.plans import reports
from larder.plans.lineage import pins_released
from larder.sources import tables


@dataclass(frozen=True)
class Settings:
    cleaning: CleaningRules = field(default_factory=CleaningRules)
    promotion: PromotionRule = field(default_factory=PromotionRule)
    abc: AbcRule = field(default_factory=AbcRule)
    stock: StockPolicy = field(default_factory=StockPolicy)
    features: FeatureRules = field(default_factory=FeatureRules)
    forecast: ForecastRules = field(default_factory=ForecastRules)
    risk: RiskRules = field(default_factory=RiskRules)
    reference_date: str | None = None


class _Store:
    """Writes a table and hands back a scan of it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        if name in schemas.TABLES:
            df = tables.conform(df, schemas.TABLES[name], name)
        tables.write_table(df, self.path(name))
        return tables.read_table(self.spark, self.path(name), df.schema)


def train_and_forecast(
    features: DataFrame, store: _Store, rules: ForecastRules
) -> tuple[DataFrame, DataFrame]:
    """Cross-validate, keep the best model and forecast the coming days."""
    spark = store.spark
    rows = store.keep(
        "model_rows",
        folds.with_min_history(
            folds.recent_history(features, rules.history_days), rules.min_history_rows
        ),
    )
    comparison = store.keep(
        "model_comparison", evaluation.rank_models(models.cross_validate(rows, rules))
    )
    best = evaluation.best_model(comparison).first()["model"]
    model = None if best == models.NAIVE else models.fit_model(rows, best, rules)
    models.save_model(spark, model, best, store.path("models"))
    if model is None:
        predicted = forecast.naive_next_days(rows, rules.horizon)
    else:
        tables.write_table(
            models.feature_importance(spark, model), store.path("feature_importance")
        )
        predicted = forecast.forecast_next_days(rows, model, rules)
    return comparison, store.keep("forecast_output", predicted)


def full_run(
    raw: DataFrame,
    terms: DataFrame,
    folder: str,
    settings: Settings = Settings(),
    holidays: Sequence[str] | DataFrame = DEFAULT_HOLIDAYS,
    skip_training: bool = False,
    stock: DataFrame | None = None,
) -> DataFrame:
    """Build and store every table under ``folder``; returns the one-row run summary.

    ``stock`` is a table of stock snapshots per product and day; without one the
    stock is projected from sales under the stock policy.

    Each stage reads the stored table of the one before, so plans stay short,
    a lost executor costs at most one stage, and small tables are broadcast
    by their real size. ``skip_training`` uses an earlier forecast if there is one.
    """
    with pins_released(raw.sparkSession):
        return _run_stages(raw, terms, folder, settings, holidays, skip_training, stock)


def _run_stages(
    raw: DataFrame,
    terms: DataFrame,
    folder: str,
    settings: Settings,
    holidays: Sequence[str] | DataFrame,
    skip_training: bool,
    snapshots: DataFrame | None,
) -> DataFrame:
    started = time.monotonic()
    spark = raw.sparkSession
    store = _Store(spark, folder)

    tx = store.keep("transactions", clean_transactions(raw, settings.cleaning))
    span = date_span(tx)
    sales = store.keep("sales_daily", build_sales_daily(tx, settings.promotion, span))
    products = store.keep(
        "sku_master", build_product_master(tx, terms, settings.reference_date, settings.abc)
    )
    calendar = store.keep("calendar", build_calendar(span, holidays))
    stock = store.keep(
        "inventory_snapshots",
        project_stock(sales, products, settings.stock) if snapshots is None else snapshots,
    )

    tables.write_features(
        build_features(sales, products, calendar, stock, settings.features),
        store.path("features"),
    )
    features = spark.read.parquet(store.path("features"))

    comparison, predicted = None, None
    if skip_training:
        earlier = tables.read_table(
            spark, store.path("forecast_output"), schemas.FORECAST_OUTPUT, required=False
        )
        predicted = None if earlier.isEmpty() else earlier
    else:
        comparison, predicted = train_and_forecast(features, store, settings.forecast)

    risk = store.keep(
        "risk_scores", by_priority(assess_risk(features, stock, products, predicted, settings.risk))
    )
    impact = store.keep("business_impact", business_impact(risk, settings.risk))
    tables.write_json(impact, store.path("business_impact_json"))
    write_aggregates(sales, products, stock, store)

    summary = run_summary(span, sales, products, features, risk, impact, comparison, predicted)
    summary = summary.withColumn("elapsed_seconds", F.lit(round(time.monotonic() - started, 2)))
    tables.write_json(summary, store.path("run_summary_json"))
    return summary


def write_aggregates(
    sales: DataFrame, products: DataFrame, stock: DataFrame, store: _Store
) -> None:
    """The small summary tables that reports read instead of the daily rows."""
    by_day = store.keep("sales_daily_agg", reports.sales_by_day(sales))
    by_product = store.keep("sku_sales_agg", reports.sales_by_product(sales))
    latest = store.keep("inventory_latest", latest_per_key(stock, "stock_code", "date"))
    store.keep("sales_weekly_agg", reports.sales_by_week(by_day))
    store.keep("category_agg", reports.sales_by_category(by_product, products))
    store.keep("low_stock_alerts", reorder_list(latest))


def run_summary(
    span: DataFrame,
    sales: DataFrame,
    products: DataFrame,
    features: DataFrame,
    risk: DataFrame,
    impact: DataFrame,
    comparison: DataFrame | None = None,
    predicted: DataFrame | None = None,
) -> DataFrame:
    """Row counts, date range, models and impact as one nested row."""
    rows = F.count(F.lit(1))
    counts = {
        "sales_daily_rows": sales.agg(rows).scalar(),
        "sku_count": products.agg(rows).scalar(),
        "first_date": span.select("first_date").scalar(),
        "last_date": span.select("last_date").scalar(),
        "feature_rows": features.agg(rows).scalar(),
        "feature_columns": F.lit(len(features.columns)),
        "total_skus": risk.agg(rows).scalar(),
    }
    if comparison is not None:
        counts["best_model"] = evaluation.best_model(comparison).select("model").scalar()
        # One entry per model.
        counts["models"] = comparison.agg(
            F.sort_array(F.collect_list(F.struct("rank", "model", *evaluation.METRICS)))
        ).scalar()
    if predicted is not None:
        counts["forecast_rows"] = predicted.agg(rows).scalar()
    return impact.select(
        *[c.alias(n) for n, c in counts.items()],
        F.struct(*impact.columns).alias("business_impact"),
    )
