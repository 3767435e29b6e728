"""Queries on customers, promotions, intervals, ranks and weeks, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from larder.operators import customers, intervals, products, promotions, ranks, safety, weekly
from larder.plans import reports
from larder.plans.lineage import pin, scratch

# Customers -------------------------------------------------------------------------


@query("rfm_scores", None, "tx", """
    SELECT *, r_score::VARCHAR || f_score::VARCHAR || m_score::VARCHAR AS rfm FROM (
        SELECT customer_id, recency_days, frequency, monetary,
               ntile(5) OVER (ORDER BY recency_days DESC, customer_id)::INT AS r_score,
               ntile(5) OVER (ORDER BY frequency, customer_id)::INT AS f_score,
               ntile(5) OVER (ORDER BY monetary, customer_id)::INT AS m_score
        FROM (SELECT customer_id, (SELECT max(date) FROM tx) - max(date) AS recency_days,
                     count(DISTINCT invoice_no) AS frequency, round(sum(revenue), 2) AS monetary
              FROM tx GROUP BY customer_id))""")
def _(shop):
    return customers.rfm_scores(shop.buyer_tx)


@query("cohort_retention", {6: "retention"}, "tx", """
    WITH firsts AS (SELECT customer_id, date_trunc('month', min(date))::DATE AS cohort FROM tx GROUP BY customer_id),
    active AS (SELECT DISTINCT customer_id, date_trunc('month', date)::DATE AS month FROM tx),
    sizes AS (SELECT cohort, count(*) AS cohort_size FROM firsts GROUP BY cohort)
    SELECT cohort, month, datediff('month', cohort, month)::INT AS month_number, count(*) AS customers, any_value(cohort_size) AS cohort_size,
           count(*) / any_value(cohort_size) AS retention
    FROM firsts JOIN active USING (customer_id) JOIN sizes USING (cohort) GROUP BY cohort, month""")
def _(shop):
    """Sets of each half of the lines, merged, as when a month's lines come in two parts."""
    tx = shop.buyer_tx
    numbers = customers.customer_numbers(tx)
    odd = F.pmod(F.xxhash64("invoice_no"), F.lit(2)) == 1
    halves = [customers.active_sets(tx.where(half), numbers) for half in (odd, ~odd)]
    return customers.cohort_retention(customers.merged_sets(*halves))


@query("abc_xyz", {4: "mean_cv"}, "sales products", """
    SELECT abc_class, CASE WHEN cv < 0.5 THEN 'X' WHEN cv < 1.0 THEN 'Y' ELSE 'Z' END AS xyz_class, count(*) AS sku_count,
           avg(cv) AS mean_cv, sum(q) AS quantity
    FROM (SELECT stock_code, stddev_samp(quantity) / nullif(avg(quantity), 0) AS cv, sum(quantity) AS q
          FROM (SELECT stock_code, date_trunc('month', date) AS month, sum(quantity) AS quantity FROM sales GROUP BY ALL) GROUP BY stock_code)
    JOIN products USING (stock_code) GROUP BY ALL""")
def _(shop):
    """Products by revenue class and by how steady their monthly demand is."""
    return products.abc_xyz(shop.sales, shop.products)


@query("year_over_year", {2: "revenue revenue_before", 6: "growth_pct"}, "by_day", """
    WITH months AS (SELECT date_trunc('month', date)::DATE AS month, sum(total_revenue) AS revenue FROM by_day GROUP BY 1)
    SELECT m.month, m.revenue, y.revenue AS revenue_before, (m.revenue - y.revenue) / nullif(y.revenue, 0) * 100 AS growth_pct
    FROM months m LEFT JOIN months y ON y.month = m.month - INTERVAL 12 MONTHS""")
def _(shop):
    return reports.year_over_year(shop.by_day)


# Ranks within groups ---------------------------------------------------------------

@query("price_percentile", {9: "price_percentile"}, "tx products", """
    SELECT invoice_no, t.stock_code, invoice_date, quantity, customer_id, unit_price, category,
           percent_rank() OVER (PARTITION BY category ORDER BY unit_price) AS price_percentile
    FROM tx t JOIN products p ON p.stock_code = t.stock_code""")
def _(shop):
    """Each line's price within its category."""
    lines = shop.buyer_tx.select("invoice_no", "stock_code", "invoice_date", "quantity", "customer_id", "unit_price")
    named = lines.join(shop.products.select("stock_code", "category"), "stock_code")
    return ranks.percent_rank(named, ["category"], "unit_price", "price_percentile")


# Promotions ------------------------------------------------------------------------

@query("promotion_lift", {6: "promoted_mean control_mean lift lift_error lift_pct"}, "sales products", """
    SELECT category, count(*) AS promotion_days, avg(quantity) AS promoted_mean, avg(control) AS control_mean,
           avg(quantity - control) AS lift, stddev_samp(quantity - control) / sqrt(count(*)) AS lift_error,
           avg(quantity - control) / nullif(avg(control), 0) * 100 AS lift_pct
    FROM (SELECT s.stock_code, s.date, s.quantity, c.quantity AS control
          FROM sales s JOIN sales c ON c.stock_code = s.stock_code AND c.is_promotion = 0 AND c.date < s.date
                                   AND c.date >= s.date - 56 AND isodow(c.date) = isodow(s.date)
          WHERE s.is_promotion = 1
          QUALIFY row_number() OVER (PARTITION BY s.stock_code, s.date ORDER BY c.date DESC) = 1) m
    JOIN products p ON p.stock_code = m.stock_code GROUP BY category""")
def _(shop):
    matches = promotions.matched_promotions(shop.sales).join(shop.products.select("stock_code", "category"), "stock_code")
    return promotions.promotion_lift(matches, ["category"])


@query("year_ago_demand", {6: "quantity_mean_52w"}, "flagged", """
    SELECT f.stock_code, f.date, f.quantity, f.is_promotion, y.quantity AS quantity_lag_52w,
           (SELECT avg(w.quantity) FROM flagged w WHERE w.stock_code = f.stock_code
            AND w.date BETWEEN f.date - 367 AND f.date - 361) AS quantity_mean_52w,
           floor((f.date - (SELECT max(w.date) FROM flagged w WHERE w.stock_code = f.stock_code AND w.is_promotion = 1
                            AND w.date < f.date)) / 7)::INT AS weeks_since_promotion
    FROM flagged f LEFT JOIN flagged y ON y.stock_code = f.stock_code AND y.date = f.date - 364""")
def _(shop):
    """On the days with sales only, so many days are missing."""
    daily = shop.flagged.select("stock_code", "date", "quantity", "is_promotion")
    return promotions.calendar_features(daily)


# Intervals -------------------------------------------------------------------------

_KEYS = ["step", "abc_class"]
_CONFORMAL = """
    WITH back_days AS (SELECT date, row_number() OVER (ORDER BY date DESC) AS back FROM (SELECT DISTINCT date FROM sales)),
    folds(fold, first_back, last_back) AS (VALUES ('calibration', 29, 56), ('held_out', 1, 28)),
    hist AS (SELECT fold, stock_code, isodow(s.date) AS dow, quantity FROM sales s JOIN back_days b ON b.date = s.date
             JOIN folds ON b.back > last_back),
    predicted AS (
        SELECT f.fold, t.stock_code, last_back - d.back + 1 AS step, abc_class, t.quantity AS actual,
               round(greatest(coalesce(h.mean, 0), 0), 6) AS predicted
        FROM sales t JOIN back_days d ON d.date = t.date JOIN folds f ON d.back BETWEEN first_back AND last_back
        JOIN products p ON p.stock_code = t.stock_code
        LEFT JOIN (SELECT fold, stock_code, dow, avg(quantity) AS mean FROM hist GROUP BY ALL) h
               ON h.fold = f.fold AND h.stock_code = t.stock_code AND h.dow = isodow(t.date)),
    residuals AS (SELECT *, round(abs(actual - predicted), 6) AS residual FROM predicted),
    radii AS (SELECT step, abc_class, residual AS radius, n AS residuals
              FROM (SELECT *, row_number() OVER (PARTITION BY step, abc_class ORDER BY residual) AS nth,
                           count(*) OVER (PARTITION BY step, abc_class) AS n FROM residuals WHERE fold = 'calibration')
              WHERE nth = least(ceil((n + 1) * 0.9::DOUBLE), n))"""


def _bands(shop):
    calibration, held_out = intervals.split_folds(shop.sales)
    classes = shop.products.select("stock_code", "abc_class")
    radius = intervals.conformal_radius(pin(calibration.join(classes, "stock_code")), _KEYS)
    return radius, intervals.with_band(held_out.join(classes, "stock_code"), radius, _KEYS)


@query("conformal_radius", {6: "radius"}, "sales products", f"{_CONFORMAL} SELECT step, abc_class, radius, residuals FROM radii")
def _(shop):
    return _bands(shop)[0]


@query("interval_coverage", {6: "coverage_pct mean_radius SMAPE"}, "sales products", f"""{_CONFORMAL}
    SELECT abc_class, count(radius) AS banded_rows, avg((residual <= radius)::INT) * 100 AS coverage_pct, avg(radius) AS mean_radius,
           avg(CASE WHEN abs(actual) + abs(predicted) = 0 THEN 0
                    ELSE 2 * abs(actual - predicted) / (abs(actual) + abs(predicted)) END) * 100 AS SMAPE
    FROM residuals r LEFT JOIN radii q USING (step, abc_class) WHERE fold = 'held_out' GROUP BY abc_class""")
def _(shop):
    return intervals.interval_report(_bands(shop)[1], ["abc_class"])


# Weeks -----------------------------------------------------------------------------

@query("weekly_demand", {2: "revenue"}, "tx", """
    WITH sold AS (SELECT stock_code, date_trunc('week', date)::DATE AS week, sum(quantity) AS quantity, sum(revenue) AS revenue,
                         count(*) AS line_count FROM tx GROUP BY 1, 2),
    spine AS (SELECT stock_code, unnest(generate_series(min(week), (SELECT max(week) FROM sold), INTERVAL 7 DAY))::DATE AS week
              FROM sold GROUP BY stock_code)
    SELECT stock_code, week, coalesce(quantity, 0) AS quantity, coalesce(revenue, 0) AS revenue, coalesce(line_count, 0) AS line_count
    FROM spine LEFT JOIN sold USING (stock_code, week)""")
def _(shop):
    """After three batches by year, of which one is sent twice; some lines come a batch late."""
    store = weekly.WeeklyDemand(shop.spark, scratch(shop.spark, "weekly"))
    year = F.year("date")
    usual = F.when(year < 1997, 0).when(year < 1999, 1).otherwise(2)
    late = F.pmod(F.xxhash64("invoice_no"), F.lit(16)) == 0
    part = F.when(late, F.least(usual + 1, F.lit(2))).otherwise(usual)
    for batch in (0, 1, 1, 2):
        store.take(shop.buyer_tx.where(part == batch), batch)
    return weekly.with_zero_weeks(store.demand())


# Stock -----------------------------------------------------------------------------

@query("safety_stock", {9: "z", 4: "safety_stock reorder_point"}, "sales products", """
    SELECT s.stock_code, p AS service_level, z, lead_time_days, z * sd * sqrt(lead_time_days) AS safety_stock,
           d * lead_time_days + z * sd * sqrt(lead_time_days) AS reorder_point
    FROM (SELECT stock_code, avg(quantity) AS d, stddev_samp(quantity) AS sd FROM sales GROUP BY stock_code) s
    JOIN products USING (stock_code)
    CROSS JOIN (VALUES (0.9::DOUBLE, 1.2815515655446004::DOUBLE), (0.95, 1.6448536269514722), (0.975, 1.959963984540054),
                       (0.99, 2.3263478740408408), (0.999, 3.090232306167813)) t(p, z)""")
def _(shop):
    return safety.safety_stock(shop.sales, shop.products)
