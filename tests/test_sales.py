import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from larder.config import AbcRule
from larder.operators.calendar import build_calendar
from larder.operators.daily import build_sales_daily, daily_sales, fill_missing_days, flag_promotions
from larder.operators.ordered import bucket_counts, exact_median, last_rows, latest_per_key
from larder.operators.products import classify_abc, most_common

DAY = dt.date(2011, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def sale_days(spark, rows):
    return spark.createDataFrame(
        [(c, day(n), q, q * p, p, 1, 1) for c, n, q, p in rows],
        "stock_code string, date date, quantity double, revenue double, avg_unit_price double, "
        "num_orders bigint, num_customers bigint",
    )


def test_daily_sums_and_distinct_counts(spark):
    tx = spark.createDataFrame(
        [("a", DAY, 2.0, 10.0, 5.0, "1", "x"), ("a", DAY, 3.0, 30.0, 10.0, "1", None),
         ("a", DAY, 1.0, 6.0, 6.0, "2", "x")],
        "stock_code string, date date, quantity double, revenue double, unit_price double, "
        "invoice_no string, customer_id string",
    )
    (row,) = daily_sales(tx).collect()
    assert (row["quantity"], row["revenue"], row["avg_unit_price"]) == (6.0, 46.0, 7.0)
    assert (row["num_orders"], row["num_customers"]) == (2, 1)
    (row,) = daily_sales(tx.drop("customer_id")).collect()
    assert row["num_customers"] == 2


def test_distinct_values_travel_without_the_sums(spark):
    """Missing keys and values, and each count against one made by hand."""
    rows = [(code, date, invoice, customer, 2.0, 3.0, price)
            for code in ("a", "b", None) for date in (DAY, None) for invoice in ("1", "2", None)
            for customer, price in (("x", 1.0), ("y", None), (None, None))]
    rows.append(("c", DAY, None, None, None, None, None))
    tx = spark.createDataFrame(
        rows * 2, "stock_code string, date date, invoice_no string, customer_id string, quantity double, revenue double, unit_price double")
    daily = daily_sales(tx)
    assert dict(daily.dtypes) == {"stock_code": "string", "date": "date", "quantity": "double", "revenue": "double",
                                  "avg_unit_price": "double", "num_orders": "bigint", "num_customers": "bigint"}
    found = {(r["stock_code"], r["date"]): tuple(r)[2:] for r in daily.collect()}
    assert found.pop(("c", DAY)) == (None, None, None, 0, 0)
    assert found == {(c, d): (36.0, 54.0, 1.0, 2, 2) for c in ("a", "b", None) for d in (DAY, None)}
    # One expanded row a line and count, with the buffers of all sums, is what filled a task's memory.
    assert "Expand" not in daily._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("earlier, price, expected", [(5, 84.0, 1), (4, 1.0, 0), (5, 85.0, 0)])
def test_promotion_needs_five_earlier_days_and_a_strictly_lower_price(spark, earlier, price, expected):
    rows = [("a", 3 * n, 1.0, 100.0) for n in range(earlier)] + [("a", 100, 1.0, price)]
    flagged = flag_promotions(sale_days(spark, rows)).orderBy("date").collect()
    assert [r["is_promotion"] for r in flagged] == [0] * earlier + [expected]


def test_missing_days(spark):
    rows = [("a", 0, 1.0, 5.0), ("a", 3, 2.0, 6.0), ("b", 2, 4.0, 7.0), ("b", 5, 1.0, 8.0)]
    dense = fill_missing_days(flag_promotions(sale_days(spark, rows))).toPandas()
    assert len(dense) == 2 * 6
    by = {k: g.sort_values("date") for k, g in dense.groupby("stock_code")}
    assert by["a"].avg_unit_price.tolist() == [5, 5, 5, 6, 6, 6]
    assert by["b"].avg_unit_price.tolist() == [7, 7, 7, 7, 7, 8]
    assert by["b"].quantity.tolist() == [0, 0, 4, 0, 0, 1]
    assert by["b"].revenue.tolist() == [0, 0, 28, 0, 0, 8]
    assert by["b"].num_orders.tolist() == [0, 0, 1, 0, 0, 1]


def test_missing_days_need_no_cross_join(spark):
    plan = fill_missing_days(flag_promotions(sale_days(spark, [("a", 0, 1.0, 5.0)])))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def profile(spark, revenues):
    return spark.createDataFrame(list(revenues.items()), "stock_code string, total_revenue double")


def test_abc_limits(spark):
    got = classify_abc(profile(spark, {"p": 80.0, "q": 15.0, "r": 5.0})).collect()
    assert {r["stock_code"]: r["abc_class"] for r in got} == {"p": "A", "q": "B", "r": "C"}
    got = classify_abc(profile(spark, {"p": 81.0, "q": 14.0, "r": 5.0})).collect()
    assert {r["stock_code"]: r["abc_class"] for r in got} == {"p": "B", "q": "B", "r": "C"}


def test_abc_with_many_equal_revenues_matches_one_ordered_pass(spark):
    rng = np.random.default_rng(3)
    revenues = {f"k{i:04d}": float(v) for i, v in enumerate(rng.integers(1, 60, 600))}
    revenues |= {f"t{i:04d}": 50.0 for i in range(300)}
    got = {r["stock_code"]: r["abc_class"] for r in classify_abc(profile(spark, revenues)).collect()}
    total, running, rule = sum(revenues.values()), 0.0, AbcRule()
    for code in sorted(revenues, key=lambda c: (-revenues[c], c)):
        running += revenues[code]
        want = "A" if running <= rule.a_share * total else "B" if running <= rule.b_share * total else "C"
        assert got[code] == want


def test_exact_median_matches_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in rng.normal(0, 1e3, 2001)]
    rows += [("even", float(v)) for v in np.round(rng.lognormal(1, 2, 500), 2)]
    rows += [("same", 4.25)] * 1000 + [("two", 1.0), ("two", 2.0), ("null", None)]
    rows += [("close", 1.0 + i * 1e-12) for i in range(101)]
    got = exact_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", "m").collect()
    got = {r["k"]: r["m"] for r in got}
    assert set(got) == {"hot", "even", "same", "two", "close"}
    for key, value in got.items():
        assert value == pytest.approx(np.median([v for k, v in rows if k == key]), abs=1e-13)


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", None), ("b", "y"), ("b", "y"), ("b", "a")],
                               "k string, v string")
    got = {r["k"]: r["m"] for r in most_common(df, "k", "v", "m").collect()}
    assert got == {"a": "b", "b": "y"}


def test_latest_takes_the_last_known_value_of_each_column(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, None, "y"), ("b", 1, None, None)],
                               "k string, t int, v int, w string")
    got = {r["k"]: (r["t"], r["v"], r["w"]) for r in latest_per_key(df, "k", "t").collect()}
    assert got == {"a": (2, 5, "y"), "b": (1, None, None)}


def test_last_rows(spark):
    df = spark.createDataFrame([("a", n) for n in range(9)] + [("b", 1)], "k string, t int")
    got = last_rows(df, "k", "t", 3).collect()
    assert sorted((r["k"], r["t"]) for r in got) == [("a", 6), ("a", 7), ("a", 8), ("b", 1)]


def test_buckets_keep_the_top_edge(spark):
    df = spark.createDataFrame([(0.0,), (9.0,), (365.0,), (9999.0,)], "v double")
    got = {r["bucket"]: r["n"] for r in bucket_counts(df, "v", 0, 365, 40).collect()}
    assert got == {1: 2, 40: 2}


def test_calendar_edges(spark):
    span = spark.sql("select date'2010-11-01' as first_date, date'2014-12-31' as last_date")
    rows = {str(r["date"]): r for r in build_calendar(span).collect()}
    assert rows["2011-01-01"]["week_of_year"] == 52
    assert rows["2010-11-26"]["is_black_friday"] == 1 and rows["2010-11-29"]["is_cyber_monday"] == 1
    assert rows["2013-11-22"]["is_black_friday"] == 1 and rows["2013-11-29"]["is_black_friday"] == 0
    assert rows["2014-11-28"]["is_black_friday"] == 1 and rows["2014-12-01"]["is_cyber_monday"] == 0
    assert (rows["2011-12-25"]["days_to_christmas"], rows["2011-12-26"]["days_to_christmas"]) == (0, 0)
    assert (rows["2011-10-31"]["days_to_newyear"], rows["2011-11-01"]["days_to_newyear"]) == (0, 61)
    assert rows["2012-02-29"]["is_month_end"] == 1 and rows["2012-02-29"]["day_of_year"] == 60
    assert rows["2011-05-02"]["is_holiday"] == 1 and rows["2011-12-25"]["is_holiday"] == 0
    assert rows["2011-01-03"]["day_of_week"] == 0 and rows["2011-12-01"]["season"] == "winter"


def test_whole_sales_table_sums_units(spark):
    rng = np.random.default_rng(1)
    rows = [(f"k{rng.integers(5)}", day(int(rng.integers(40))), float(q), 2.0 * q, 2.0, str(i), "c")
            for i, q in enumerate(rng.integers(1, 9, 200).tolist())]
    tx = spark.createDataFrame(
        rows, "stock_code string, date date, quantity double, revenue double, unit_price double, "
              "invoice_no string, customer_id string")
    dense = build_sales_daily(tx).toPandas()
    span = (max(r[1] for r in rows) - min(r[1] for r in rows)).days + 1
    assert len(dense) == 5 * span
    assert dense.quantity.sum() == sum(r[2] for r in rows)
    assert not dense.duplicated(["stock_code", "date"]).any()
    assert pd.notna(dense.avg_unit_price).all()
