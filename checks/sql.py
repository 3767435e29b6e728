"""Independent SQL for the registered queries, as reusable WITH parts."""

from __future__ import annotations

#: The numbers of the feature history.
HISTORY_NUMBERS = (
    "quantity", "revenue", "unit_price", "num_orders", "num_customers", "is_promotion",
    *[f"quantity_lag{n}" for n in (1, 7, 14, 21, 28, 35)], *[f"revenue_lag{n}" for n in (7, 14, 28)], "qty_lag7_same_dow",
    *[f"{name}_roll_{stat}_{w}" for name, widths in (("quantity", (7, 14, 28, 56)), ("revenue", (7, 28)))
      for w in widths for stat in ("mean", "median", "std")],
    "price_change_7d", "price_vs_avg", "promotion_lag1", "promotion_roll7", "cumulative_qty", "demand_trend_slope", "revenue_trend",
    "demand_momentum", "demand_volatility", "demand_acceleration", "revenue_vs_28d_avg", "qty_ewma_7", "qty_ewma_28",
)

PARTS = {
    "raw": ("", """
        SELECT (CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END) || l_orderkey::VARCHAR AS invoice_no,
               p_name AS stock_code, p_name AS description, l_quantity AS quantity,
               l_shipdate AS invoice_date, round(l_extendedprice / l_quantity) AS unit_price,
               o_custkey::VARCHAR AS customer_id, n_name AS country
        FROM lineitem JOIN part ON l_partkey = p_partkey
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey"""),
    "tx": ("raw", """
        SELECT DISTINCT invoice_no, upper(trim(stock_code)) AS stock_code,
               array_to_string(list_transform(string_split(lower(trim(description)), ' '),
                                              lambda w: upper(w[1]) || w[2:]), ' ') AS description,
               quantity, invoice_date, unit_price, customer_id, country,
               invoice_date::DATE AS date, quantity * unit_price AS revenue
        FROM raw
        WHERE invoice_date IS NOT NULL AND NOT starts_with(invoice_no, 'C')
          AND trim(stock_code) NOT IN
              ('POST','DOT','BANK','PADS','M','S','ADJUST','AMAZFIT','gift')
          AND quantity > 0 AND unit_price > 0"""),
    "daily": ("tx", """
        SELECT stock_code, date, sum(quantity) AS quantity, sum(revenue) AS revenue,
               avg(unit_price) AS avg_unit_price, count(DISTINCT invoice_no) AS num_orders,
               count(DISTINCT customer_id) AS num_customers
        FROM tx GROUP BY stock_code, date"""),
    "flagged": ("daily", """
        SELECT *, CASE WHEN count(avg_unit_price) OVER w >= 5
                        AND avg_unit_price < 0.85 * avg(avg_unit_price) OVER w
                       THEN 1 ELSE 0 END AS is_promotion
        FROM daily
        WINDOW w AS (PARTITION BY stock_code ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"""),
    "days": ("tx", """
        SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM tx"""),
    "sales": ("flagged days", """
        SELECT stock_code, date, quantity, quantity * price AS revenue, price AS avg_unit_price,
               num_orders, num_customers, is_promotion
        FROM (SELECT k.stock_code, d.date, coalesce(f.quantity, 0) AS quantity,
                     coalesce(f.num_orders, 0) AS num_orders,
                     coalesce(f.num_customers, 0) AS num_customers,
                     coalesce(f.is_promotion, 0) AS is_promotion,
                     coalesce(last_value(f.avg_unit_price IGNORE NULLS) OVER (
                                  PARTITION BY k.stock_code ORDER BY d.date
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                              first_value(f.avg_unit_price IGNORE NULLS) OVER (
                                  PARTITION BY k.stock_code ORDER BY d.date
                                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price
              FROM (SELECT DISTINCT stock_code FROM flagged) k CROSS JOIN days d
              LEFT JOIN flagged f ON f.stock_code = k.stock_code AND f.date = d.date)"""),
    "profile": ("tx", """
        SELECT stock_code, min(description) AS description, median(unit_price) AS avg_unit_price,
               min(unit_price) AS min_price, max(unit_price) AS max_price,
               sum(revenue) AS total_revenue, sum(quantity) AS total_quantity,
               min(invoice_date) AS first_sale_date, max(invoice_date) AS last_sale_date
        FROM tx GROUP BY stock_code"""),
    "classed": ("profile", """
        SELECT *, CASE WHEN run <= 0.80 * tot THEN 'A' WHEN run <= 0.95 * tot THEN 'B' ELSE 'C' END
                  AS abc_class
        FROM (SELECT *, sum(total_revenue) OVER (ORDER BY total_revenue DESC, stock_code
                            ROWS UNBOUNDED PRECEDING) AS run,
                     sum(total_revenue) OVER () AS tot FROM profile)"""),
    "terms": ("", """
        SELECT stock_code, (k % 12 + 3)::INT AS lead_time_days, ((k % 9 + 1) * 12)::INT AS moq,
               s_name AS supplier, 'Warehouse_' || (k % 4)::VARCHAR AS warehouse,
               ((k * 37) % 1460 + 365)::INT AS shelf_life_days
        FROM (SELECT upper(trim(p_name)) AS stock_code, min(p_partkey) AS k FROM part GROUP BY 1)
        LEFT JOIN supplier ON s_suppkey = k % 10"""),
    "products": ("classed terms", """
        SELECT c.stock_code, description, avg_unit_price, min_price, max_price, total_revenue,
               total_quantity, first_sale_date, last_sale_date,
               CASE WHEN regexp_matches(upper(description), 'HOME|DECOR|FRAME|SIGN|WALL|MIRROR|CANDLE|LAMP') THEN 'home_decor'
                    WHEN regexp_matches(upper(description), 'MUG|CUP|PLATE|BOWL|KITCHEN|COOK|CAKE|BAKING') THEN 'kitchen'
                    WHEN regexp_matches(upper(description), 'GARDEN|PLANT|FLOWER|SEED|OUTDOOR') THEN 'garden'
                    WHEN regexp_matches(upper(description), 'GIFT|WRAP|BOX|BAG|BIRTHDAY|CHRISTM|XMAS|PARTY') THEN 'gifts'
                    WHEN regexp_matches(upper(description), 'PAPER|CARD|BOOK|PEN|PENCIL|NOTE|DIARY') THEN 'stationery'
                    WHEN regexp_matches(upper(description), 'TOY|GAME|DOLL|PLAY|PUZZLE|KIDS') THEN 'toys'
                    WHEN regexp_matches(upper(description), 'SCARF|HAT|BAG|PURSE|JEWEL|NECKLACE|BRACELET') THEN 'fashion'
                    WHEN regexp_matches(upper(description), 'BOX|TIN|BASKET|STORAGE|RACK|SHELF|ORGANIS') THEN 'storage'
                    WHEN regexp_matches(upper(description), 'POST|DOT|BANK|PADS|ADJUST|M|S|AMAZFIT') THEN 'services'
                    ELSE 'miscellaneous' END AS category,
               lead_time_days, moq, abc_class,
               floor((epoch((SELECT max(date) FROM tx)::TIMESTAMP) - epoch(first_sale_date)) / 86400)::INT
                   AS days_since_launch,
               supplier, warehouse, shelf_life_days
        FROM classed c LEFT JOIN terms t ON c.stock_code = t.stock_code"""),
    "calendar": ("days", """
        SELECT date, year(date) AS year, month(date) AS month, monthname(date) AS month_name,
               quarter(date) AS quarter, weekofyear(date) AS week_of_year,
               isodow(date) - 1 AS day_of_week, dayname(date) AS day_name, day(date) AS day_of_month,
               dayofyear(date) AS day_of_year, (isodow(date) >= 6)::INT AS is_weekend,
               (day(date) = 1)::INT AS is_month_start, (last_day(date) = date)::INT AS is_month_end,
               (last_day(date) = date AND month(date) IN (3, 6, 9, 12))::INT AS is_quarter_end,
               (strftime(date, '%m-%d') IN ('01-01', '12-25', '12-26'))::INT AS is_holiday,
               CASE WHEN month(date) IN (12, 1, 2) THEN 'winter' WHEN month(date) <= 5 THEN 'spring'
                    WHEN month(date) <= 8 THEN 'summer' ELSE 'autumn' END AS season,
               (month(date) IN (11, 12))::INT AS is_christmas_season,
               (date = bf)::INT AS is_black_friday,
               (date = bf + 3 AND month(date) = 11)::INT AS is_cyber_monday,
               greatest(make_date(year(date), 12, 25) - date, 0) AS days_to_christmas,
               greatest(make_date(year(date) + (month(date) >= 11)::INT, 1, 1) - date, 0) AS days_to_newyear
        FROM (SELECT date, make_date(year(date), 11, 1)
                         + ((5 - isodow(make_date(year(date), 11, 1)) + 7) % 7)::INT + 21 AS bf
              FROM days)"""),
    "policy": ("sales products", """
        SELECT s.stock_code, d, lead_time_days AS lead, avg_unit_price AS price,
               greatest(d * (lead_time_days * 1.5), d * 2) AS rop,
               greatest(sqrt(2 * (d * 365) * 50.0 / greatest(avg_unit_price * 0.20, 0.01)),
                        lead_time_days * d * 2, 12.0) AS eoq, n, q, first_date
        FROM (SELECT stock_code, avg(quantity) AS d, count(*) AS n, list(quantity ORDER BY date) AS q,
                     min(date) AS first_date
              FROM sales GROUP BY stock_code) s
        JOIN products p ON p.stock_code = s.stock_code"""),
    "ledger": ("policy", """
        SELECT stock_code, -1 AS i, d * 84 AS closing, -1 AS due, 0::DOUBLE AS sold, 0 AS ordered FROM policy
        UNION ALL
        SELECT stock_code, i, closing, CASE WHEN closing <= rop AND due <= i THEN i + lead ELSE due END,
               sold, CASE WHEN closing <= rop AND due <= i THEN 1 ELSE 0 END
        FROM (SELECT stock_code, i, greatest(have - least(have, wanted), 0) AS closing, due,
                     least(have, wanted) AS sold, rop, lead
              FROM (SELECT l.stock_code, l.i + 1 AS i, l.due, p.rop, p.lead, p.q[l.i + 2] AS wanted,
                           l.closing + CASE WHEN l.due = l.i + 1 AND l.due >= 0
                                            THEN round_even(p.eoq, 0) ELSE 0 END AS have
                    FROM ledger l JOIN policy p ON p.stock_code = l.stock_code
                    WHERE l.i + 1 < p.n))"""),
    "stock": ("ledger", """
        SELECT l.stock_code, first_date + i AS date, closing + sold AS opening_inventory,
               sold AS units_sold, closing AS closing_inventory, ordered AS reorder_triggered,
               round_even(rop * 100, 0) / 100 AS reorder_point, round_even(eoq * 100, 0) / 100 AS eoq,
               round_even(closing * price * 100, 0) / 100 AS inventory_value,
               CASE WHEN d > 0 THEN round_even(closing / d * 100, 0) / 100 ELSE 999 END AS coverage_days,
               round_even(d * 10000, 0) / 10000 AS avg_daily_demand
        FROM ledger l JOIN policy p ON p.stock_code = l.stock_code WHERE i >= 0"""),
    "latest": ("stock", """
        SELECT * FROM stock QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY date DESC) = 1"""),
    "roll": ("sales", """
        SELECT *, row_number() OVER w AS n,
               avg(quantity) OVER w7 AS m7, median(quantity) OVER w7 AS md7, stddev_samp(quantity) OVER w7 AS s7,
               avg(quantity) OVER w14 AS m14, median(quantity) OVER w14 AS md14, stddev_samp(quantity) OVER w14 AS s14,
               avg(quantity) OVER w28 AS m28, median(quantity) OVER w28 AS md28, stddev_samp(quantity) OVER w28 AS s28,
               avg(quantity) OVER w56 AS m56, median(quantity) OVER w56 AS md56, stddev_samp(quantity) OVER w56 AS s56,
               avg(revenue) OVER w7 AS rm7, median(revenue) OVER w7 AS rmd7, stddev_samp(revenue) OVER w7 AS rs7,
               avg(revenue) OVER w28 AS rm28, median(revenue) OVER w28 AS rmd28, stddev_samp(revenue) OVER w28 AS rs28
        FROM sales
        WINDOW w AS (PARTITION BY stock_code ORDER BY date),
               w7 AS (PARTITION BY stock_code ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
               w14 AS (PARTITION BY stock_code ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING),
               w28 AS (PARTITION BY stock_code ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING),
               w56 AS (PARTITION BY stock_code ORDER BY date ROWS BETWEEN 56 PRECEDING AND 1 PRECEDING)"""),
    "momentum": ("roll", """
        SELECT *, demand_momentum - lag(demand_momentum, 1, demand_momentum) OVER (
                      PARTITION BY stock_code ORDER BY date) AS demand_acceleration
        FROM (SELECT stock_code, date, quantity, revenue, avg_unit_price AS unit_price,
                     coalesce(CASE WHEN n > 3 THEN m7 END
                              / CASE WHEN n > 14 THEN greatest(m28, 0.001) END, 1.0) AS demand_momentum,
                     coalesce(CASE WHEN n > 14 THEN s28 / greatest(m28, 0.001) END, 0.0) AS demand_volatility,
                     coalesce(revenue / CASE WHEN n > 14 THEN greatest(rm28, 0.001) END, 1.0)
                         AS revenue_vs_28d_avg
              FROM roll)"""),
    "ewma": ("roll", """
        SELECT a.stock_code, a.date,
               CASE WHEN a.n > 3 THEN sum(b.quantity * pow(1 - 2 / 8.0, a.n - 1 - b.n)) / sum(pow(1 - 2 / 8.0, a.n - 1 - b.n)) END AS qty_ewma_7,
               CASE WHEN a.n > 7 THEN sum(b.quantity * pow(1 - 2 / 29.0, a.n - 1 - b.n)) / sum(pow(1 - 2 / 29.0, a.n - 1 - b.n)) END AS qty_ewma_28
        FROM roll a LEFT JOIN roll b ON a.stock_code = b.stock_code AND b.n < a.n AND b.n >= a.n - 700
        GROUP BY a.stock_code, a.date, a.n"""),
    "wide": ("roll momentum ewma", """
        SELECT r.stock_code, r.date, r.quantity, r.revenue, r.avg_unit_price AS unit_price, num_orders, num_customers, is_promotion,
               LAGS, lag(r.quantity) OVER (PARTITION BY r.stock_code, isodow(r.date) ORDER BY r.date) AS qty_lag7_same_dow, ROLLS,
               coalesce(r.avg_unit_price / lag(r.avg_unit_price, 7) OVER w - 1, 0) AS price_change_7d,
               coalesce(r.avg_unit_price / avg(r.avg_unit_price) OVER (PARTITION BY r.stock_code ORDER BY r.date
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS price_vs_avg,
               coalesce(lag(is_promotion) OVER w, 0) AS promotion_lag1,
               sum(is_promotion) OVER (PARTITION BY r.stock_code ORDER BY r.date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS promotion_roll7,
               sum(r.quantity) OVER (PARTITION BY r.stock_code ORDER BY r.date ROWS UNBOUNDED PRECEDING) AS cumulative_qty,
               CASE WHEN n > 14 THEN regr_slope(r.quantity, n) OVER s ELSE 0 END AS demand_trend_slope,
               CASE WHEN n > 14 THEN regr_slope(r.revenue, n) OVER s ELSE 0 END AS revenue_trend,
               demand_momentum, demand_volatility, demand_acceleration, revenue_vs_28d_avg, qty_ewma_7, qty_ewma_28
        FROM roll r JOIN momentum m ON m.stock_code = r.stock_code AND m.date = r.date
        JOIN ewma e ON e.stock_code = r.stock_code AND e.date = r.date
        WINDOW w AS (PARTITION BY r.stock_code ORDER BY r.date),
               s AS (PARTITION BY r.stock_code ORDER BY r.date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)""".replace(
            "LAGS", ", ".join(f"lag(r.{c}, {n}) OVER w AS {c}_lag{n}" for c, ns in (("quantity", (1, 7, 14, 21, 28, 35)), ("revenue", (7, 14, 28))) for n in ns)
        ).replace("ROLLS", ", ".join(
            f"CASE WHEN n > {w // 2} THEN {p}{a}{w} END AS {name}_roll_{stat}_{w}"
            for name, p, widths in (("quantity", "", (7, 14, 28, 56)), ("revenue", "r", (7, 28)))
            for w in widths for stat, a in (("mean", "m"), ("median", "md"), ("std", "s")))),
    ),
    "pairs": ("wide", """
        SELECT split_part(name, '|', 1) AS x, split_part(name, '|', 2) AS y, v.n AS n, v.c AS correlation
        FROM (UNPIVOT (SELECT PAIRS FROM wide) ON COLUMNS(*) INTO NAME name VALUE v)""".replace("PAIRS", ", ".join(
            f"{{'n': regr_count({a}, {b}), 'c': CASE WHEN isfinite(corr({a}, {b})) THEN corr({a}, {b}) END}} AS \"{a}|{b}\""
            for a in HISTORY_NUMBERS for b in HISTORY_NUMBERS)),
    ),
    "melted": ("wide", """
        SELECT feature, value FROM (SELECT FIELDS FROM wide)
        UNPIVOT INCLUDE NULLS (value FOR feature IN (NAMES))""".replace(
            "FIELDS", ", ".join(f"{c}::DOUBLE AS {c}" for c in HISTORY_NUMBERS)).replace("NAMES", ", ".join(HISTORY_NUMBERS))),
    "risk_base": ("momentum latest products", """
        SELECT l.stock_code, p.description, p.category, coalesce(p.abc_class, 'C') AS abc_class,
               l.closing_inventory, l.coverage_days, l.reorder_point, l.eoq, l.inventory_value,
               s.avg_daily_demand, s.std_daily_demand, s.avg_unit_price, s.total_revenue,
               s.demand_momentum, coalesce(p.lead_time_days, 7) AS lead_time_days
        FROM latest l
        LEFT JOIN (SELECT stock_code, avg(quantity) AS avg_daily_demand,
                          stddev_samp(quantity) AS std_daily_demand,
                          arg_max(demand_momentum, date) AS demand_momentum,
                          sum(revenue) AS total_revenue, avg(unit_price) AS avg_unit_price
                   FROM momentum GROUP BY stock_code) s ON s.stock_code = l.stock_code
        LEFT JOIN products p ON p.stock_code = l.stock_code"""),
    "scored": ("risk_base", """
        SELECT *, least(greatest(CASE WHEN coverage_days <= 0 THEN 100.0
                        WHEN coverage_days < lead_time_days THEN 90 - (coverage_days / lead_time_days) * 40
                        WHEN coverage_days < 7 THEN 70 - (coverage_days / 7) * 30
                        WHEN coverage_days < 14 THEN 40 - ((coverage_days - 7) / 7) * 20
                        WHEN coverage_days < 30 THEN 20 - (coverage_days / 30) * 15
                        ELSE 5.0 END + least(demand_cv * 10, 20), 0), 100) AS stockout_score,
               least(greatest(CASE WHEN coverage_days > 365 THEN 90.0
                        WHEN coverage_days > 90 THEN 60 + ((coverage_days - 90) / 275) * 30
                        WHEN coverage_days > 60 THEN 30 + ((coverage_days - 60) / 30) * 30
                        ELSE coverage_days / 60 * 15 END, 0), 100) AS overstock_score
        FROM (SELECT *, coalesce(std_daily_demand / greatest(avg_daily_demand, 0.001), 0) AS demand_cv
              FROM risk_base)"""),
    "levelled": ("scored", """
        SELECT *, round_even((stockout_score * 0.60 + overstock_score * 0.40) * 100, 0) / 100 AS risk_score,
               CASE WHEN stockout_score >= 75 THEN 'Critical Stockout Risk'
                    WHEN stockout_score >= 50 THEN 'High Stockout Risk'
                    WHEN stockout_score >= 30 THEN 'Moderate Stockout Risk'
                    WHEN overstock_score >= 70 THEN 'Overstock Risk'
                    WHEN overstock_score >= 40 THEN 'Mild Overstock Risk'
                    WHEN demand_cv > 1.5 THEN 'Volatile Demand' ELSE 'Healthy' END AS risk_level
        FROM scored"""),
    "risk": ("levelled", """
        SELECT stock_code, description, category, abc_class, closing_inventory, coverage_days,
               reorder_point, eoq, avg_daily_demand, avg_unit_price, lead_time_days, demand_cv,
               demand_momentum, stockout_score, overstock_score, risk_score, risk_level,
               round_even(CASE WHEN risk_level LIKE '%Stockout%'
                    THEN greatest(14 - coverage_days, 0) * avg_daily_demand * avg_unit_price * 2
                    ELSE 0 END * 100, 0) / 100 AS revenue_at_risk,
               round_even(CASE WHEN risk_level LIKE '%Overstock%'
                    THEN greatest(coverage_days - 60, 0) / greatest(coverage_days, 1)
                         * closing_inventory * avg_unit_price ELSE 0 END * 100, 0) / 100 AS capital_locked,
               round_even(risk_score * CASE abc_class WHEN 'A' THEN 3.0 WHEN 'B' THEN 2.0 ELSE 1.0 END
                          * 100, 0) / 100 AS priority_score,
               CASE risk_level WHEN 'Critical Stockout Risk' THEN '🚨 Reorder Immediately'
                    WHEN 'High Stockout Risk' THEN '📦 Increase Purchase'
                    WHEN 'Moderate Stockout Risk' THEN
                        CASE WHEN demand_momentum > 1.2 THEN '📦 Increase Purchase'
                             ELSE '📊 Monitor Closely' END
                    WHEN 'Overstock Risk' THEN
                        CASE WHEN abc_class = 'C' THEN '🏷 Clearance Sale'
                             WHEN coverage_days > 180 THEN '🔗 Bundle Offer'
                             ELSE '📉 Markdown Promotion' END
                    WHEN 'Mild Overstock Risk' THEN '📉 Reduce Purchase'
                    WHEN 'Volatile Demand' THEN '📊 Monitor Closely'
                    ELSE '✅ Healthy – No Action' END AS recommendation,
               avg_daily_demand * 28 AS forecast_qty,
               round_even(avg_daily_demand * 28 * avg_unit_price * 100, 0) / 100 AS forecast_revenue,
               inventory_value
        FROM levelled"""),
    "impact": ("risk", """
        SELECT r AS revenue_at_risk, f AS forecast_revenue_28d, v AS inventory_value, c AS capital_locked,
               round_even(c * 0.70::DOUBLE * 100, 0) / 100 AS working_capital_saved,
               round_even(r * 0.85::DOUBLE * 100, 0) / 100 AS potential_sales_increase,
               round_even(c * 0.20::DOUBLE / 12 * 100, 0) / 100 AS overstock_cost_monthly,
               round_even(r * 1.5::DOUBLE * 100, 0) / 100 AS stockout_cost,
               round_even((r * 0.85::DOUBLE - r * 1.5::DOUBLE + c * 0.70::DOUBLE) * 100, 0) / 100
                   AS expected_profit_improvement,
               critical_stockout_count, high_stockout_count, overstock_count, healthy_count, total_skus
        FROM (SELECT sum(revenue_at_risk::DECIMAL(24, 2))::DOUBLE AS r,
                     sum(forecast_revenue::DECIMAL(24, 2))::DOUBLE AS f,
                     sum(inventory_value::DECIMAL(24, 2))::DOUBLE AS v,
                     sum(capital_locked::DECIMAL(24, 2))::DOUBLE AS c,
                     count(*) FILTER (risk_level = 'Critical Stockout Risk') AS critical_stockout_count,
                     count(*) FILTER (risk_level = 'High Stockout Risk') AS high_stockout_count,
                     count(*) FILTER (risk_level LIKE '%Overstock%') AS overstock_count,
                     count(*) FILTER (risk_level = 'Healthy') AS healthy_count,
                     count(*) AS total_skus FROM risk)"""),
    "by_day": ("sales", """
        SELECT date, sum(quantity) AS total_quantity, sum(revenue) AS total_revenue,
               count(*) AS sku_count, sum(is_promotion) AS promo_days FROM sales GROUP BY date"""),
    "by_product": ("sales", """
        SELECT stock_code, sum(quantity) AS total_quantity,
               sum(round(revenue, 6)::DECIMAL(28, 6))::DOUBLE AS total_revenue,
               avg(avg_unit_price) AS avg_price, max(date) FILTER (quantity > 0) AS last_sale,
               min(date) FILTER (quantity > 0) AS first_sale FROM sales GROUP BY stock_code"""),
    "fold_dates": ("sales", """
        SELECT date, row_number() OVER (ORDER BY date DESC) AS back FROM (SELECT DISTINCT date FROM sales)"""),
    "naive": ("sales fold_dates", """
        SELECT t.stock_code, t.date, t.quantity AS actual,
               greatest(coalesce(w.m, a.m, 0), 0) AS predicted
        FROM sales t JOIN fold_dates f ON f.date = t.date AND f.back <= 28
        LEFT JOIN (SELECT stock_code, isodow(date) AS dow, avg(quantity) AS m
                   FROM sales JOIN fold_dates USING (date) WHERE back > 28 GROUP BY ALL) w
               ON w.stock_code = t.stock_code AND w.dow = isodow(t.date)
        LEFT JOIN (SELECT stock_code, avg(quantity) AS m
                   FROM sales JOIN fold_dates USING (date) WHERE back > 28 GROUP BY ALL) a
               ON a.stock_code = t.stock_code"""),
    "moving": ("sales fold_dates", """
        SELECT t.stock_code, t.date, t.quantity AS actual, greatest(coalesce(a.m, 0), 0) AS predicted
        FROM sales t JOIN fold_dates f ON f.date = t.date AND f.back <= 28
        LEFT JOIN (SELECT stock_code, avg(quantity) AS m
                   FROM sales JOIN fold_dates USING (date) WHERE back BETWEEN 29 AND 35
                   GROUP BY ALL) a ON a.stock_code = t.stock_code"""),
    "forecast": ("sales", """
        SELECT k.stock_code, d.date, greatest(coalesce(w.m, 0), 0) AS forecast_quantity
        FROM (SELECT DISTINCT stock_code FROM sales) k
        CROSS JOIN (SELECT (SELECT max(date) FROM sales) + i AS date
                    FROM (SELECT unnest(range(1, 29))::INT AS i)) d
        LEFT JOIN (SELECT stock_code, isodow(date) AS dow, avg(quantity) AS m FROM sales GROUP BY ALL) w
               ON w.stock_code = k.stock_code AND w.dow = isodow(d.date)"""),
    "metrics": ("naive moving", """
        SELECT model, coalesce(sum(abs(e)) / nullif(sum(abs(actual)), 0), 0) * 100 AS WAPE,
               coalesce(avg(abs(e / actual)) FILTER (actual > 1e-8), 0) * 100 AS MAPE,
               avg(abs(e)) AS MAE, sqrt(avg(e * e)) AS RMSE, avg(e) AS Bias,
               coalesce(median(abs(e / actual)) FILTER (actual > 1e-8), 0) * 100 AS MdAPE
        FROM (SELECT 'SeasonalNaive' AS model, actual, predicted - actual AS e FROM naive
              UNION ALL SELECT 'MovingAverage', actual, predicted - actual FROM moving)
        GROUP BY model"""),
}


def _needed(names: str, seen: list[str]) -> list[str]:
    for name in names.split():
        if name not in seen:
            _needed(PARTS[name][0], seen)
            if name not in seen:
                seen.append(name)
    return seen


def with_parts(names: str, select: str) -> str:
    """``select`` preceded by the named parts and whatever they need."""
    parts = _needed(names, [])
    columns = {"ledger": "ledger(stock_code, i, closing, due, sold, ordered)"}
    clauses = [f"{columns.get(p, p)} AS {'' if p == 'ledger' else 'MATERIALIZED '}({PARTS[p][1]})"
               for p in parts]
    return f"WITH RECURSIVE {', '.join(clauses)}\n{select}" if clauses else select


def rounded(select: str, places: dict[int, str]) -> str:
    """Round the named columns half to even; ``places`` maps decimals to column names.

    Adding 0.0 turns a rounded -0.0 into 0.0.
    """
    changes = [
        f"round_even({c} * 1e{n}, 0) / 1e{n} + 0.0 AS {c}"
        for n, names in places.items() for c in names.split()
    ]
    return f"SELECT * REPLACE ({', '.join(changes)}) FROM ({select})"
