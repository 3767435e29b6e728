import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.config import RiskRules
from larder.functions.scoring import overstock_score, recommended_action, risk_level, stockout_score
from larder.operators.risk import add_forecast_revenue, business_impact, impact_waterfall, score_products
from larder.operators.stock import project_stock, reorder_list, reorder_policy

DAY = dt.date(2011, 1, 1)


@pytest.fixture(scope="module")
def ledger(spark):
    rng = np.random.default_rng(2)
    demand = {
        "steady": np.full(200, 5.0), "none": np.zeros(200),
        "spike": np.r_[np.zeros(150), 5000.0, np.ones(49)],
        "noisy": rng.integers(0, 20, 200).astype(float),
    }
    rows = [(c, DAY + dt.timedelta(days=i), float(q)) for c, d in demand.items() for i, q in enumerate(d)]
    sales = spark.createDataFrame(rows, "stock_code string, date date, quantity double")
    products = spark.createDataFrame(
        [("steady", 10, 2.0), ("none", 5, 3.0), ("spike", 3, 1.0), ("noisy", 14, 100.0)],
        "stock_code string, lead_time_days int, avg_unit_price double")
    got = project_stock(sales, products).toPandas().sort_values(["stock_code", "date"])
    policy = {r["stock_code"]: r for r in reorder_policy(sales, products).collect()}
    return demand, policy, {k: g.reset_index(drop=True) for k, g in got.groupby("stock_code")}


@pytest.mark.parametrize("code", ["steady", "none", "spike", "noisy"])
def test_ledger_conserves_units(ledger, code):
    demand, policy, books = ledger
    book, terms = books[code], policy[code]
    order, lead = round(terms["eoq"]), terms["lead_time_days"]
    assert (book.closing_inventory >= 0).all()
    assert np.allclose(book.opening_inventory - book.units_sold, book.closing_inventory)
    assert (book.units_sold <= demand[code]).all()
    placed = np.flatnonzero(book.reorder_triggered)
    assert (np.diff(placed) >= lead).all(), "a second order while one is on its way"
    received = np.zeros(len(book))
    for i in placed:
        if i + lead < len(book):
            received[i + lead] += order
    before = np.r_[demand[code].mean() * 84, book.closing_inventory[:-1]]
    assert np.allclose(before + received, book.opening_inventory)


def test_ledger_without_demand(ledger):
    book = ledger[2]["none"]
    assert (book.coverage_days == 999).all() and (book.eoq == 12).all()


def test_lost_sales(ledger):
    demand, _, books = ledger
    assert books["spike"].units_sold.sum() < demand["spike"].sum()


def test_reorder_list(spark):
    df = spark.createDataFrame([("a", 5.0, 5.0), ("b", 6.0, 5.0)],
                               "stock_code string, closing_inventory double, reorder_point double")
    assert [r["stock_code"] for r in reorder_list(df).collect()] == ["a"]


def test_stockout_scores(spark):
    cases = [
        (0, 7, 0, 100), (3.5, 7, 0, 70), (7, 7, 0, 40), (6, 5, 0, 70 - 6 / 7 * 30),
        (10.5, 7, 0, 30), (14, 7, 0, 13), (29.9, 7, 0, 20 - 29.9 / 2), (30, 7, 0, 5),
        (8, 14, 0, 90 - 8 / 14 * 40), (100, 7, 3, 25), (100, 7, 1.5, 20), (0, 7, 2, 100),
    ]
    df = spark.createDataFrame([(float(c), int(l), float(v), float(w)) for c, l, v, w in cases],
                               "c double, l int, v double, want double")
    score = stockout_score(F.col("c"), F.col("l"), F.col("v"), RiskRules())
    for row in df.withColumn("got", score).collect():
        assert row["got"] == pytest.approx(row["want"]), row


def test_overstock_scores(spark):
    cases = [(0, 0), (60, 15), (75, 45), (90, 60), (180, 60 + 90 / 275 * 30), (365, 90), (999, 90)]
    df = spark.createDataFrame([(float(c), float(w)) for c, w in cases], "c double, want double")
    for row in df.withColumn("got", overstock_score(F.col("c"), RiskRules())).collect():
        assert row["got"] == pytest.approx(row["want"])


def test_levels_and_actions(spark):
    cases = [
        (75, 90, 0, "Critical Stockout Risk", 200, 1, "A", "🚨 Reorder Immediately"),
        (50, 90, 0, "High Stockout Risk", 200, 1, "A", "📦 Increase Purchase"),
        (30, 90, 0, "Moderate Stockout Risk", 9, 1.2, "A", "📊 Monitor Closely"),
        (30, 90, 0, "Moderate Stockout Risk", 9, 1.21, "A", "📦 Increase Purchase"),
        (29.9, 70, 0, "Overstock Risk", 181, 1, "C", "🏷 Clearance Sale"),
        (29.9, 70, 0, "Overstock Risk", 181, 1, "B", "🔗 Bundle Offer"),
        (29.9, 70, 0, "Overstock Risk", 180, 1, "B", "📉 Markdown Promotion"),
        (5, 40, 2, "Mild Overstock Risk", 70, 1, "A", "📉 Reduce Purchase"),
        (5, 39, 1.51, "Volatile Demand", 50, 1, "A", "📊 Monitor Closely"),
        (5, 39, 1.5, "Healthy", 50, 1, "A", "✅ Healthy – No Action"),
    ]
    df = spark.createDataFrame(
        [(float(s), float(o), float(v), lv, float(c), float(m), abc, act) for s, o, v, lv, c, m, abc, act in cases],
        "s double, o double, v double, level string, c double, m double, abc string, act string")
    df = df.withColumn("got", risk_level(F.col("s"), F.col("o"), F.col("v"), RiskRules()))
    df = df.withColumn("do", recommended_action(F.col("got"), F.col("c"), F.col("m"), F.col("abc")))
    for row in df.collect():
        assert (row["got"], row["do"]) == (row["level"], row["act"])


def scored_row(spark, **changes):
    base = dict(stock_code="x", coverage_days=2.0, lead_time_days=7, avg_daily_demand=4.0,
                std_daily_demand=4.0, avg_unit_price=5.0, closing_inventory=8.0,
                demand_momentum=1.0, abc_class="B") | changes
    return score_products(spark.createDataFrame([base])).first()


def test_amounts(spark):
    row = scored_row(spark)
    assert row["risk_level"] == "Critical Stockout Risk"
    assert row["revenue_at_risk"] == 12 * 4 * 5 * 2 and row["capital_locked"] == 0
    assert row["priority_score"] == pytest.approx(row["risk_score"] * 2, abs=0.01)
    row = scored_row(spark, coverage_days=120.0, closing_inventory=480.0, std_daily_demand=0.0)
    assert row["capital_locked"] == 60 / 120 * 480 * 5 and row["revenue_at_risk"] == 0


def test_products_without_forecast_stay_null(spark):
    risk = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 2.0)],
                                 "stock_code string, avg_daily_demand double, avg_unit_price double")
    made = spark.createDataFrame([("a", 3.0), ("a", 4.0)], "stock_code string, forecast_quantity double")
    got = {r["stock_code"]: r["forecast_revenue"] for r in add_forecast_revenue(risk, made).collect()}
    assert got == {"a": 14.0, "b": None}
    got = {r["stock_code"]: r["forecast_qty"] for r in add_forecast_revenue(risk, None).collect()}
    assert got == {"a": 28.0, "b": 28.0}


def test_impact_arithmetic(spark):
    risk = spark.createDataFrame(
        [("Critical Stockout Risk", 98851.49, 0.0, 1.0, 2.0), ("Mild Overstock Risk", 0.0, 957622.87, 1.0, 2.0)],
        "risk_level string, revenue_at_risk double, capital_locked double, forecast_revenue double, "
        "inventory_value double")
    impact = business_impact(risk)
    row = impact.first()
    assert row["potential_sales_increase"] == 84023.77 and row["overstock_cost_monthly"] == 15960.38
    assert row["working_capital_saved"] == 670336.01
    assert row["expected_profit_improvement"] == 606082.54
    assert (row["critical_stockout_count"], row["overstock_count"], row["total_skus"]) == (1, 1, 2)
    steps = impact_waterfall(impact).orderBy("step").collect()
    assert [s["measure"] for s in steps] == ["absolute"] + ["relative"] * 4 + ["total"]
    assert steps[0]["amount"] == -98851.49
