"""Risk score per product and business impact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder.config import RiskRules
from larder.functions.numbers import half_even
from larder.functions.scoring import (
    CRITICAL, HEALTHY, HIGH, capital_locked, overstock_score, recommended_action,
    revenue_at_risk, risk_level, stockout_score,
)
from larder.operators.ordered import latest_per_key

COLUMNS = (
    "stock_code", "description", "category", "abc_class", "closing_inventory",
    "coverage_days", "reorder_point", "eoq", "avg_daily_demand", "avg_unit_price",
    "lead_time_days", "demand_cv", "demand_momentum", "stockout_score",
    "overstock_score", "risk_score", "risk_level", "revenue_at_risk", "capital_locked",
    "priority_score", "recommendation", "forecast_qty", "forecast_revenue",
    "inventory_value",
)


def demand_stats(features: DataFrame) -> DataFrame:
    """Demand level, spread, latest momentum, revenue and mean price per product."""
    names = features.columns
    momentum = "demand_momentum" if "demand_momentum" in names else "quantity"
    stats = {
        "avg_daily_demand": F.avg("quantity"),
        "std_daily_demand": F.stddev_samp("quantity"),
        "demand_momentum": F.max_by(momentum, F.when(F.col(momentum).isNotNull(), F.col("date"))),
        "total_revenue": F.sum("revenue" if "revenue" in names else "quantity"),
    }
    if "unit_price" in names:
        stats["avg_unit_price"] = F.avg("unit_price")
    return features.groupBy("stock_code").agg(*[c.alias(n) for n, c in stats.items()])


def risk_inputs(
    features: DataFrame, stock: DataFrame, products: DataFrame, rules: RiskRules = RiskRules()
) -> DataFrame:
    """Latest stock, demand and product attributes per product, with defaults.

    All three sides are one row per stock code.
    """
    stats = demand_stats(features)
    latest = latest_per_key(stock, "stock_code", "date")
    latest = latest.drop(*[c for c in stats.columns if c != "stock_code"])
    attributes = products.select(
        "stock_code", "category", "abc_class", "lead_time_days", "description",
        F.col("avg_unit_price").alias("_list_price"),
    )
    joined = latest.join(stats, "stock_code", "left").join(attributes, "stock_code", "left")
    if "avg_unit_price" not in stats.columns:
        joined = joined.withColumn("avg_unit_price", F.col("_list_price"))
    return joined.drop("_list_price").fillna(
        {
            "avg_unit_price": rules.default_price, "avg_daily_demand": 0.0, "std_daily_demand": 0.0,
            "coverage_days": 0.0, "closing_inventory": 0.0, "lead_time_days": rules.default_lead_days,
            "demand_momentum": rules.default_momentum, "abc_class": rules.default_class,
        }
    )


def _abc_weight(rules: RiskRules) -> Column:
    weight = F.lit(None).cast("double")
    for name, value in rules.abc_weights.items():
        weight = F.when(F.col("abc_class") == name, value).otherwise(weight)
    return F.coalesce(weight, F.lit(1.0))


def score_products(inputs: DataFrame, rules: RiskRules = RiskRules()) -> DataFrame:
    """Scores, level, action and amounts; one projection after another, no shuffle."""
    cover, cv = F.col("coverage_days"), F.col("demand_cv")
    level, price = F.col("risk_level"), F.col("avg_unit_price")
    spread = F.col("std_daily_demand") / F.greatest(F.col("avg_daily_demand"), F.lit(0.001))
    return (
        inputs.withColumn("demand_cv", F.coalesce(spread, F.lit(0.0)))
        .withColumns(
            {
                "stockout_score": stockout_score(cover, F.col("lead_time_days"), cv, rules),
                "overstock_score": overstock_score(cover, rules),
            }
        )
        .withColumns(
            {
                "risk_score": half_even(
                    F.col("stockout_score") * rules.stockout_weight
                    + F.col("overstock_score") * rules.overstock_weight
                ),
                "risk_level": risk_level(
                    F.col("stockout_score"), F.col("overstock_score"), cv, rules
                ),
            }
        )
        .withColumns(
            {
                "recommendation": recommended_action(
                    level, cover, F.col("demand_momentum"), F.col("abc_class"), rules
                ),
                "revenue_at_risk": half_even(
                    revenue_at_risk(level, cover, F.col("avg_daily_demand"), price, rules)
                ),
                "capital_locked": half_even(
                    capital_locked(level, cover, F.col("closing_inventory"), price, rules)
                ),
                "priority_score": half_even(F.col("risk_score") * _abc_weight(rules)),
            }
        )
    )


def add_forecast_revenue(
    scored: DataFrame, forecast: DataFrame | None, rules: RiskRules = RiskRules()
) -> DataFrame:
    """Forecast units and revenue.

    With a forecast table, products it lacks stay null. Without one, mean
    demand over the forecast horizon is used.
    """
    if forecast is None:
        scored = scored.withColumn("forecast_qty", F.col("avg_daily_demand") * rules.forecast_days)
    else:
        units = forecast.groupBy("stock_code").agg(F.sum("forecast_quantity").alias("forecast_qty"))
        scored = scored.join(units, "stock_code", "left")
    return scored.withColumn(
        "forecast_revenue", half_even(F.col("forecast_qty") * F.col("avg_unit_price"))
    )


def assess_risk(
    features: DataFrame,
    stock: DataFrame,
    products: DataFrame,
    forecast: DataFrame | None = None,
    rules: RiskRules = RiskRules(),
) -> DataFrame:
    """The risk table: one row per product. Sort with :func:`by_priority`."""
    scored = score_products(risk_inputs(features, stock, products), rules)
    return add_forecast_revenue(scored, forecast, rules).select(*COLUMNS)


def by_priority(risk: DataFrame) -> DataFrame:
    return risk.orderBy(F.desc("priority_score"), "stock_code")


def business_impact(risk: DataFrame, rules: RiskRules = RiskRules()) -> DataFrame:
    """Money and count totals over all products, one row.

    The amounts have two places, so they are summed as decimals: the totals
    do not depend on the order in which partitions arrive.
    """
    level = F.col("risk_level")

    def total(amount: str) -> Column:
        exact = F.sum(F.col(amount).cast("decimal(24,2)"))
        return F.coalesce(exact.cast("double"), F.lit(0.0))

    sums = risk.agg(
        total("revenue_at_risk").alias("at_risk"),
        total("forecast_revenue").alias("forecast"),
        total("inventory_value").alias("stock_value"),
        total("capital_locked").alias("locked"),
        F.count_if(level == CRITICAL).alias("critical_stockout_count"),
        F.count_if(level == HIGH).alias("high_stockout_count"),
        F.count_if(level.contains("Overstock")).alias("overstock_count"),
        F.count_if(level == HEALTHY).alias("healthy_count"),
        F.count(F.lit(1)).alias("total_skus"),
    )
    at_risk, locked = F.col("at_risk"), F.col("locked")
    cost, saved = at_risk * rules.stockout_cost_factor, locked * rules.reducible_share
    recovered = at_risk * rules.recovery_share
    return sums.select(
        half_even(at_risk).alias("revenue_at_risk"),
        half_even(F.col("forecast")).alias("forecast_revenue_28d"),
        half_even(F.col("stock_value")).alias("inventory_value"),
        half_even(locked).alias("capital_locked"),
        half_even(saved).alias("working_capital_saved"),
        half_even(recovered).alias("potential_sales_increase"),
        half_even(locked * rules.holding_rate / 12).alias("overstock_cost_monthly"),
        half_even(cost).alias("stockout_cost"),
        half_even(recovered - cost + saved).alias("expected_profit_improvement"),
        "critical_stockout_count", "high_stockout_count", "overstock_count",
        "healthy_count", "total_skus",
    )


# --- Fixed values -----------------------------------------------------------
# Steps of the waterfall: label, measure, and the total it shows.
WATERFALL = (
    ("Current Revenue at Risk", "absolute", "revenue_at_risk"),
    ("Stockout Recovery", "relative", "potential_sales_increase"),
    ("Overstock Savings", "relative", "overstock_cost_monthly"),
    ("Working Capital", "relative", "working_capital_saved"),
    ("Other", "relative", None),
    ("Net Benefit", "total", "expected_profit_improvement"),
)
# ----------------------------------------------------------------------------


def impact_waterfall(impact: DataFrame) -> DataFrame:
    """The impact totals as ordered waterfall steps; what is at risk counts against the rest."""
    sign = {"revenue_at_risk": -1}
    steps = [
        (label, measure, F.lit(0.0) if name is None else F.col(name) * sign.get(name, 1)) for label, measure, name in WATERFALL
    ]
    rows = [
        F.struct(
            F.lit(i).alias("step"), F.lit(label).alias("label"),
            F.lit(measure).alias("measure"), amount.alias("amount"),
        )
        for i, (label, measure, amount) in enumerate(steps, 1)
    ]
    return impact.select(F.inline(F.array(*rows)))
