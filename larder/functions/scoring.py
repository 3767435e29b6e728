"""Risk rules as expressions over the columns of one product row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from larder.config import (
    ACTION_BUNDLE, ACTION_CLEARANCE, ACTION_INCREASE, ACTION_MARKDOWN, ACTION_MONITOR,
    ACTION_NONE, ACTION_REDUCE, ACTION_REORDER, RISK_LEVELS, RiskRules,
)

(CRITICAL, HIGH, MODERATE, OVERSTOCK, MILD_OVERSTOCK, VOLATILE, HEALTHY) = RISK_LEVELS


def _within(score: Column) -> Column:
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0))


def stockout_score(cover: Column, lead: Column, cv: Column, rules: RiskRules) -> Column:
    """0-100, higher the fewer days the stock lasts; erratic demand adds to it."""
    critical, high = rules.critical_days, rules.high_days
    base = (
        F.when(cover <= 0, rules.empty_score)
        .when(cover < lead, rules.lead_score - (cover / lead) * rules.lead_drop)
        .when(cover < critical, rules.critical_score - (cover / critical) * rules.critical_drop)
        .when(cover < high, rules.high_score - ((cover - critical) / (high - critical)) * rules.high_drop)
        .when(cover < rules.watch_days, rules.watch_score - (cover / rules.watch_days) * rules.watch_drop)
        .otherwise(rules.covered_score)
    )
    return _within(base + F.least(cv * rules.cv_points, F.lit(rules.cv_most)))


def overstock_score(cover: Column, rules: RiskRules) -> Column:
    """0-100, higher the longer the stock lasts."""
    balanced, over, dead = rules.balanced_days, rules.overstock_days, rules.dead_days
    base = (
        F.when(cover > dead, rules.dead_score)
        .when(cover > over, rules.over_score + ((cover - over) / (dead - over)) * rules.over_rise)
        .when(cover > balanced, rules.balanced_score + ((cover - balanced) / (over - balanced)) * rules.balanced_rise)
        .otherwise((cover / balanced) * rules.covered_rise)
    )
    return _within(base)


def risk_level(stockout: Column, overstock: Column, cv: Column, rules: RiskRules) -> Column:
    """Stockout is tested first, then overstock, then volatility."""
    return (
        F.when(stockout >= rules.critical_level, CRITICAL)
        .when(stockout >= rules.high_level, HIGH)
        .when(stockout >= rules.moderate_level, MODERATE)
        .when(overstock >= rules.overstock_level, OVERSTOCK)
        .when(overstock >= rules.mild_overstock_level, MILD_OVERSTOCK)
        .when(cv > rules.volatile_cv, VOLATILE)
        .otherwise(HEALTHY)
    )


def recommended_action(level: Column, cover: Column, momentum: Column, abc: Column, rules: RiskRules = RiskRules()) -> Column:
    rising = momentum > rules.rising_momentum
    return (
        F.when(level == CRITICAL, ACTION_REORDER)
        .when((level == HIGH) | ((level == MODERATE) & rising), ACTION_INCREASE)
        .when((level == MODERATE) | (level == VOLATILE), ACTION_MONITOR)
        .when((level == OVERSTOCK) & (abc == "C"), ACTION_CLEARANCE)
        .when((level == OVERSTOCK) & (cover > rules.bundle_days), ACTION_BUNDLE)
        .when(level == OVERSTOCK, ACTION_MARKDOWN)
        .when(level == MILD_OVERSTOCK, ACTION_REDUCE)
        .otherwise(ACTION_NONE)
    )


def revenue_at_risk(
    level: Column, cover: Column, demand: Column, price: Column, rules: RiskRules
) -> Column:
    days = F.greatest(F.lit(rules.high_days) - cover, F.lit(0.0))
    return F.when(level.contains("Stockout"), days * demand * price * rules.penalty).otherwise(0.0)


def capital_locked(
    level: Column, cover: Column, on_hand: Column, price: Column, rules: RiskRules
) -> Column:
    excess = F.greatest(cover - rules.balanced_days, F.lit(0.0))
    share = excess / F.greatest(cover, F.lit(1.0))
    return F.when(level.contains("Overstock"), share * on_hand * price).otherwise(0.0)
