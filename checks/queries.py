"""Every registered query with, where SQL can answer it, the SQL for the same tables.

Floating results are rounded on both sides.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from checks.registry import QUERIES, Query, query, run  # noqa: F401
from checks.sql import HISTORY_NUMBERS, rounded, with_parts
from larder.config import ForecastRules
from larder.functions.numbers import half_even
from larder.functions.text import product_category, title_case
from larder.operators import baselines, evaluation, features as feats, folds, forecast, models, quality
from larder.operators.calendar import build_calendar
from larder.operators.cleaning import canonical_names, clean_transactions, rejected_lines
from larder.operators.daily import build_sales_daily, daily_sales, flag_promotions
from larder.operators.ordered import bucket_counts, last_rows
from larder.operators.products import most_common
from larder.operators.risk import add_forecast_revenue, impact_waterfall, risk_inputs, score_products
from larder.operators.stock import reorder_list, reorder_policy
from larder.plans import exports, lookups, reports
from larder.config import CleaningRules, RiskRules
from larder.sources import tpch
from larder.sources.tables import as_records


# Cleaning and quality ------------------------------------------------------------

@query("clean_tx", {2: "revenue"}, "tx",
       "SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, "
       "customer_id, country, date, revenue FROM tx")
def _(shop):
    return tpch.transactions(shop.spark, shop.folder)


@query("clean_tx_country", {2: "revenue"}, "tx",
       "SELECT invoice_no, stock_code, quantity, unit_price, date, revenue FROM tx "
       "WHERE country = 'NATION_7'")
def _(shop):
    rules = CleaningRules(country="NATION_7")
    return clean_transactions(shop.raw, rules).select(
        "invoice_no", "stock_code", "quantity", "unit_price", "date", "revenue"
    )


@query("dedupe_tx", None, "raw",
       "SELECT count(*) AS row_count, count(DISTINCT r) AS distinct_rows, "
       "count(*) - count(DISTINCT r) AS duplicate_rows FROM (SELECT raw AS r FROM raw)")
def _(shop):
    copies = shop.raw.groupBy(*shop.raw.columns).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("distinct_rows"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicate_rows"),
    )


@query("title_case", None, "",
       r"""SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(
               lower(p_name || ' ' || p_brand || '-' || p_type || '''s ' || p_size::VARCHAR || 'x'),
               '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '') AS title FROM part""")
def _(shop):
    text = F.concat_ws("", "p_name", F.lit(" "), "p_brand", F.lit("-"), "p_type",
                       F.lit("'s "), F.col("p_size").cast("string"), F.lit("x"))
    return shop.table("part").select("p_partkey", title_case(text).alias("title"))


@query("category_rule", None, "", """
    SELECT p_partkey, CASE
        WHEN regexp_matches(d, 'HOME|DECOR|FRAME|SIGN|WALL|MIRROR|CANDLE|LAMP') THEN 'home_decor'
        WHEN regexp_matches(d, 'MUG|CUP|PLATE|BOWL|KITCHEN|COOK|CAKE|BAKING') THEN 'kitchen'
        WHEN regexp_matches(d, 'GARDEN|PLANT|FLOWER|SEED|OUTDOOR') THEN 'garden'
        WHEN regexp_matches(d, 'GIFT|WRAP|BOX|BAG|BIRTHDAY|CHRISTM|XMAS|PARTY') THEN 'gifts'
        WHEN regexp_matches(d, 'PAPER|CARD|BOOK|PEN|PENCIL|NOTE|DIARY') THEN 'stationery'
        WHEN regexp_matches(d, 'TOY|GAME|DOLL|PLAY|PUZZLE|KIDS') THEN 'toys'
        WHEN regexp_matches(d, 'SCARF|HAT|BAG|PURSE|JEWEL|NECKLACE|BRACELET') THEN 'fashion'
        WHEN regexp_matches(d, 'BOX|TIN|BASKET|STORAGE|RACK|SHELF|ORGANIS') THEN 'storage'
        WHEN regexp_matches(d, 'POST|DOT|BANK|PADS|ADJUST|M|S|AMAZFIT') THEN 'services'
        WHEN k < 22 THEN 'home_decor' WHEN k < 50 THEN 'gifts' WHEN k < 75 THEN 'kitchen'
        ELSE 'storage' END AS category
    FROM (SELECT p_partkey, upper(p_name) AS d,
                 CASE WHEN length(p_partkey::VARCHAR) >= 2
                      THEN substr(p_partkey::VARCHAR, 1, 2)::INT ELSE 0 END AS k FROM part)""")
def _(shop):
    code = F.col("p_partkey").cast("string")
    return shop.table("part").select(
        "p_partkey", product_category(F.col("p_name"), code).alias("category")
    )


@query("quality_overview", {6: "avg_null_pct duplicate_pct"}, "raw", """
    SELECT count(*) AS row_count,
           (count(*) FILTER (invoice_no IS NULL) + count(*) FILTER (stock_code IS NULL)
            + count(*) FILTER (description IS NULL) + count(*) FILTER (quantity IS NULL)
            + count(*) FILTER (invoice_date IS NULL) + count(*) FILTER (unit_price IS NULL)
            + count(*) FILTER (customer_id IS NULL) + count(*) FILTER (country IS NULL))
           / (count(*) * 8.0) * 100 AS avg_null_pct,
           (count(*) - count(DISTINCT r)) / count(*) * 100 AS duplicate_pct,
           2 AS numeric_columns, 5 AS text_columns
    FROM (SELECT *, raw AS r FROM raw)""")
def _(shop):
    return quality.quality_overview(shop.raw)


_TEXT_LINES = """
    SELECT l_orderkey::VARCHAR AS invoice_no, ' ' || lower(p_name) || ' ' AS stock_code,
           CASE WHEN l_linenumber % 5 <> 0 THEN p_name END AS description, l_orderkey AS k,
           l_quantity::INT AS quantity, round(l_extendedprice / l_quantity)::INT AS unit_price, l_shipdate::DATE AS day
    FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _text_lines(shop) -> DataFrame:
    """The benchmark's lines as a careless export writes them: all text, some of it broken."""
    lines = shop.table("lineitem").join(shop.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    key, day = F.col("l_orderkey"), F.col("l_shipdate").cast("timestamp")

    def written(number, modulus):
        text = number.cast("int").cast("string")
        forms = {0: F.lit("NaN"), 1: F.lit(""), 2: F.concat(text, F.lit("d")), 3: F.lit("nan"),
                 4: F.concat(F.lit("  "), text, F.lit(" ")), 5: F.concat(F.lit("-"), text), 6: F.concat(text, F.lit("e0"))}
        choice = text
        for rest, form in forms.items():
            choice = F.when(key % modulus == rest, form).otherwise(choice)
        return choice

    when = (
        F.when(key % 17 == 0, F.date_format(day, "dd.MM.yyyy"))
        .when(key % 3 == 0, F.date_format(day, "M/d/yyyy H:mm"))
        .when(key % 3 == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return lines.select(
        key.cast("string").alias("invoice_no"), F.concat(F.lit(" "), F.lower("p_name"), F.lit(" ")).alias("stock_code"),
        F.when(F.col("l_linenumber") % 5 != 0, F.col("p_name")).alias("description"),
        written(F.col("l_quantity"), 19).alias("quantity"), when.alias("invoice_date"),
        written(F.round(F.col("l_extendedprice") / F.col("l_quantity")), 23).alias("unit_price"),
    )


_BROKEN = "k % 17 = 0", "k % 19 IN (0, 1, 2, 3, 5)", "k % 23 IN (0, 1, 2, 3, 5)"


@query("clean_text_tx", None, "", f"""
    SELECT DISTINCT invoice_no, upper(trim(stock_code)) AS stock_code,
           CASE WHEN description IS NULL THEN 'Nan' ELSE array_to_string(list_transform(
               string_split(lower(trim(description)), ' '), lambda w: upper(w[1]) || w[2:]), ' ') END AS description,
           quantity::DOUBLE AS quantity, unit_price::DOUBLE AS unit_price, day AS date,
           (quantity * unit_price)::DOUBLE AS revenue
    FROM ({_TEXT_LINES}) WHERE NOT ({' OR '.join(_BROKEN)})""")
def _(shop):
    rules = CleaningRules(country=None)
    return clean_transactions(_text_lines(shop), rules).drop("invoice_date")


@query("rejected_lines", None, "", f"""
    SELECT reason, count(*) AS line_count FROM (
        SELECT CASE WHEN {_BROKEN[0]} THEN 'unreadable_date' WHEN {_BROKEN[1]} THEN 'quantity_not_positive'
                    WHEN {_BROKEN[2]} THEN 'price_not_positive' END AS reason FROM ({_TEXT_LINES}))
    WHERE reason IS NOT NULL GROUP BY reason""")
def _(shop):
    return rejected_lines(_text_lines(shop), CleaningRules(country=None))


@query("schema_report", None, "", f"""
    SELECT column1 AS required_column, column2 AS status, column3 AS matched_as,
           CASE column1 WHEN 'StockCode' THEN codes WHEN 'Description' THEN names WHEN 'Quantity' THEN numbers
                        WHEN 'InvoiceDate' THEN days WHEN 'UnitPrice' THEN prices ELSE 0 END AS usable_values, row_count
    FROM (SELECT unnest(['InvoiceNo', 'StockCode', 'Description', 'Quantity', 'InvoiceDate', 'UnitPrice', 'CustomerID', 'Country']) AS column1,
                 unnest(['Missing', 'Found', 'Found', 'Found', 'Found', 'Found', 'Missing', 'Missing']) AS column2,
                 unnest([NULL, 'stock_code', 'product_name', 'qty', 'date', 'unit_price', NULL, NULL]) AS column3)
    CROSS JOIN (SELECT count(*) AS row_count, count(*) FILTER (trim(stock_code) <> '') AS codes, count(description) AS names,
                       count(*) FILTER (k % 19 NOT IN (0, 1, 2, 3)) AS numbers, count(*) FILTER (k % 17 <> 0) AS days,
                       count(*) FILTER (k % 23 NOT IN (0, 1, 2, 3)) AS prices FROM ({_TEXT_LINES}))""")
def _(shop):
    names = {"invoice_no": "number", "description": "product_name", "quantity": "qty", "invoice_date": "date"}
    return quality.schema_report(_text_lines(shop).withColumnsRenamed(names))


@query("description_mode", None, "", """
    SELECT stock_code, description FROM (
        SELECT stock_code, description, row_number() OVER (PARTITION BY stock_code ORDER BY n DESC, description) AS nth
        FROM (SELECT p_brand AS stock_code, p_name AS description, count(*) AS n
              FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, p_name)) WHERE nth = 1""")
def _(shop):
    """Brands sell parts of many names, so this has real modes and ties."""
    lines = shop.table("lineitem").select("l_partkey")
    parts = shop.table("part").select("p_partkey", F.col("p_brand").alias("stock_code"), "p_name")
    sold = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return most_common(sold, "stock_code", "p_name", "description")


_LONGS, _INTS = ("num_orders", "num_customers", "promotion_roll7"), ("is_promotion", "promotion_lag1")
_HISTORY_TYPES = ", ".join(
    f"('{c}', '{'bigint' if c in _LONGS else 'int' if c in _INTS else 'double'}')" for c in HISTORY_NUMBERS)


@query("missing_report", {2: "null_pct"}, "melted", f"""
    SELECT feature AS column_name, count(*) FILTER (value IS NULL) AS null_count,
           count(*) FILTER (value IS NULL) / count(*) * 100 AS null_pct, any_value(dtype) AS dtype
    FROM melted JOIN (VALUES {_HISTORY_TYPES}) t(name, dtype) ON name = feature GROUP BY feature
    UNION ALL SELECT 'stock_code', count(*) FILTER (stock_code IS NULL), count(*) FILTER (stock_code IS NULL) / count(*) * 100, 'string' FROM wide
    UNION ALL SELECT 'date', count(*) FILTER (date IS NULL), count(*) FILTER (date IS NULL) / count(*) * 100, 'date' FROM wide""")
def _(shop):
    """Of all columns of the feature history."""
    return quality.missing_report(shop.history)


# Daily sales, products and calendar ---------------------------------------------

@query("daily_agg", {2: "revenue", 6: "avg_unit_price"}, "daily", "SELECT * FROM daily")
def _(shop):
    return daily_sales(shop.buyer_tx)


@query("promo_flag", {6: "avg_unit_price"}, "flagged",
       "SELECT stock_code, date, avg_unit_price, is_promotion FROM flagged")
def _(shop):
    flagged = flag_promotions(shop.daily)
    return flagged.select("stock_code", "date", "avg_unit_price", "is_promotion")


@query("sales_daily", {2: "revenue", 6: "avg_unit_price"}, "sales", "SELECT * FROM sales")
def _(shop):
    return build_sales_daily(shop.buyer_tx, span=shop.span)


@query("sku_profile", {2: "total_revenue"}, "profile", "SELECT * FROM profile")
def _(shop):
    from larder.operators.products import product_profile

    return product_profile(shop.tx)


@query("abc_class", {2: "total_revenue"}, "classed",
       "SELECT stock_code, total_revenue, abc_class FROM classed")
def _(shop):
    return shop.products.select("stock_code", "total_revenue", "abc_class")


@query("sku_master", {2: "total_revenue"}, "products", "SELECT * FROM products")
def _(shop):
    return shop.products


@query("calendar", None, "calendar", "SELECT * FROM calendar")
def _(shop):
    return shop.calendar


@query("calendar_kpis", None, "calendar",
       "SELECT count(*) AS date_rows, sum(is_holiday) AS holidays, "
       "sum(is_black_friday) AS black_fridays, sum(is_weekend) AS weekend_days FROM calendar")
def _(shop):
    return reports.calendar_kpis(shop.calendar)


# Sales reports --------------------------------------------------------------------

@query("sales_daily_agg", {2: "total_revenue"}, "by_day", "SELECT * FROM by_day")
def _(shop):
    return shop.by_day


@query("sales_weekly_agg", {2: "revenue"}, "by_day", """
    SELECT date_trunc('week', date)::DATE AS week, sum(total_quantity) AS quantity,
           sum(total_revenue) AS revenue FROM by_day
    WHERE date >= (SELECT max(date) FROM by_day) - 365 GROUP BY 1""")
def _(shop):
    return reports.sales_by_week(shop.by_day)


@query("category_agg", {2: "total_revenue"}, "by_product products", """
    SELECT category, sum(b.total_revenue) AS total_revenue, sum(b.total_quantity) AS total_quantity,
           count(*) AS sku_count
    FROM by_product b JOIN products p ON p.stock_code = b.stock_code GROUP BY category""")
def _(shop):
    return reports.sales_by_category(shop.by_product, shop.products)


@query("sku_sales_agg", {2: "total_revenue", 4: "avg_price"}, "by_product", "SELECT * FROM by_product")
def _(shop):
    return shop.by_product


@query("monthly_revenue", {2: "revenue"}, "by_day", """
    SELECT month(date) AS month, sum(total_revenue) AS revenue, sum(total_quantity) AS quantity,
           strftime(min(date), '%b') AS month_name FROM by_day GROUP BY 1""")
def _(shop):
    return reports.sales_by_month(shop.by_day)


@query("dow_profile", {6: "avg_qty"}, "by_day", """
    SELECT isodow(date) - 1 AS position, avg(total_quantity) AS avg_qty,
           strftime(min(date), '%a') AS day FROM by_day GROUP BY 1""")
def _(shop):
    return reports.sales_by_weekday(shop.by_day)


@query("abc_summary", {2: "total_revenue avg_price"}, "by_product products", """
    SELECT *, round(total_revenue / sum(total_revenue) OVER () * 100, 1) AS revenue_pct,
           round(sku_count / sum(sku_count) OVER () * 100, 1) AS sku_pct
    FROM (SELECT abc_class, count(*) AS sku_count, sum(b.total_revenue) AS total_revenue,
                 avg(p.avg_unit_price) AS avg_price
          FROM by_product b JOIN products p ON p.stock_code = b.stock_code GROUP BY abc_class)""")
def _(shop):
    return reports.abc_summary(shop.by_product, shop.products)


@query("promo_impact", {6: "mean"}, "sales", """
    SELECT CASE WHEN is_promotion = 1 THEN 'Promotion' ELSE 'Regular' END AS promo,
           avg(quantity) AS mean, sum(quantity) AS sum, median(quantity) AS median
    FROM sales GROUP BY 1""")
def _(shop):
    return reports.promotion_effect(shop.sales)


@query("promo_days", {4: "avg_qty days_pct", 2: "avg_rev"}, "by_day", """
    SELECT *, days / sum(days) OVER () * 100 AS days_pct
    FROM (SELECT CASE WHEN promo_days > 0 THEN 'Promotion' ELSE 'Regular' END AS label,
                 avg(total_quantity) AS avg_qty, avg(total_revenue) AS avg_rev, count(*) AS days
          FROM by_day GROUP BY 1)""")
def _(shop):
    return reports.promotion_days(shop.by_day)


@query("seasonality_pivot", {6: "Mon Tue Wed Thu Fri Sat Sun"}, "sales", """
    SELECT month(date) AS month,
           coalesce(avg(quantity) FILTER (isodow(date) = 1), 0) AS Mon,
           coalesce(avg(quantity) FILTER (isodow(date) = 2), 0) AS Tue,
           coalesce(avg(quantity) FILTER (isodow(date) = 3), 0) AS Wed,
           coalesce(avg(quantity) FILTER (isodow(date) = 4), 0) AS Thu,
           coalesce(avg(quantity) FILTER (isodow(date) = 5), 0) AS Fri,
           coalesce(avg(quantity) FILTER (isodow(date) = 6), 0) AS Sat,
           coalesce(avg(quantity) FILTER (isodow(date) = 7), 0) AS Sun
    FROM sales GROUP BY 1""")
def _(shop):
    return reports.seasonality(shop.sales)


@query("revenue_trend", {2: "total_revenue", 4: "ma7 ma28"}, "by_day", """
    SELECT date, total_revenue,
           avg(total_revenue) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7,
           avg(total_revenue) OVER (ORDER BY date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS ma28
    FROM by_day""")
def _(shop):
    return reports.trend(shop.by_day, "total_revenue")


@query("units_trend", {6: "ma7"}, "by_day", """
    SELECT date, total_quantity,
           avg(total_quantity) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7
    FROM by_day""")
def _(shop):
    return reports.trend(shop.by_day, "total_quantity", (7,))


@query("top_skus", {2: "total_revenue"}, "by_product products", """
    SELECT b.stock_code, coalesce(substr(description, 1, 40), b.stock_code) AS label, category, abc_class,
           b.total_revenue, b.total_quantity, '£' || format('{:,}', round_even(b.total_revenue, 0)::BIGINT) AS revenue_text
    FROM by_product b JOIN products p ON p.stock_code = b.stock_code
    ORDER BY b.total_revenue DESC, b.stock_code LIMIT 20""")
def _(shop):
    return reports.top_products(shop.by_product, shop.products)


@query("exec_kpis", {2: "total_revenue avg_daily_revenue", 6: "promo_pct a_revenue_pct avg_lead_days"},
       "by_day by_product products", """
    SELECT * FROM (SELECT sum(total_revenue) AS total_revenue, min(date) AS first_date,
                          max(date) AS last_date, avg(total_revenue) AS avg_daily_revenue,
                          arg_max(date, total_revenue) AS peak_day,
                          sum(promo_days) / sum(sku_count) * 100 AS promo_pct FROM by_day)
    CROSS JOIN (SELECT count(*) AS total_skus,
                       sum(b.total_revenue) FILTER (abc_class = 'A') / sum(b.total_revenue) * 100 AS a_revenue_pct,
                       count(DISTINCT category) AS categories, avg(lead_time_days) AS avg_lead_days
                FROM by_product b JOIN products p ON p.stock_code = b.stock_code)""")
def _(shop):
    return reports.executive_kpis(shop.by_day, shop.by_product, shop.products)


# Features -------------------------------------------------------------------------

_LAGS = ("quantity_lag1 quantity_lag7 quantity_lag14 quantity_lag21 quantity_lag28 quantity_lag35 "
         "revenue_lag7 revenue_lag14 revenue_lag28 qty_lag7_same_dow").split()


@query("lag_features", {2: "revenue_lag7 revenue_lag14 revenue_lag28"}, "sales", f"""
    SELECT stock_code, date, {', '.join(
        f"lag({c.split('_lag')[0]}, {c.split('_lag')[1]}) OVER (PARTITION BY stock_code ORDER BY date) AS {c}"
        for c in _LAGS[:-1])},
        lag(quantity) OVER (PARTITION BY stock_code, isodow(date) ORDER BY date) AS qty_lag7_same_dow
    FROM sales""")
def _(shop):
    return shop.history.select("stock_code", "date", *_LAGS)


@query("rolling_features", {
    4: "quantity_roll_mean_7 quantity_roll_median_7 quantity_roll_std_7 quantity_roll_mean_14 "
       "quantity_roll_median_14 quantity_roll_std_14 quantity_roll_mean_28 quantity_roll_median_28 "
       "quantity_roll_std_28 quantity_roll_mean_56 quantity_roll_median_56 quantity_roll_std_56",
    2: "revenue_roll_mean_7 revenue_roll_median_7 revenue_roll_std_7 revenue_roll_mean_28 "
       "revenue_roll_median_28 revenue_roll_std_28"}, "roll", f"""
    SELECT stock_code, date, {', '.join(
        f"CASE WHEN n > {w // 2} THEN {p}{a}{w} END AS {name}_roll_{stat}_{w}"
        for name, p, widths in (('quantity', '', (7, 14, 28, 56)), ('revenue', 'r', (7, 28)))
        for w in widths for stat, a in (('mean', 'm'), ('median', 'md'), ('std', 's')))}
    FROM roll""")
def _(shop):
    return shop.history.select("stock_code", "date", *feats.half_full_only())


@query("ewma_features", {6: "qty_ewma_28 qty_ewma_7_to_28"}, "sales", """
    SELECT stock_code, date, qty_ewma_28,
           CASE WHEN qty_ewma_28 > 1e-9 THEN qty_ewma_7 / qty_ewma_28 END AS qty_ewma_7_to_28
    FROM (SELECT a.stock_code, a.date,
                 CASE WHEN a.n > 3 THEN sum(b.quantity * pow(1 - 2 / 8.0, a.n - 1 - b.n))
                      / sum(pow(1 - 2 / 8.0, a.n - 1 - b.n)) END AS qty_ewma_7,
                 CASE WHEN a.n > 7 THEN sum(b.quantity * pow(1 - 2 / 29.0, a.n - 1 - b.n))
                      / sum(pow(1 - 2 / 29.0, a.n - 1 - b.n)) END AS qty_ewma_28
          FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY date) AS n FROM sales) a
          LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY date) AS n FROM sales) b
                 ON a.stock_code = b.stock_code AND b.n < a.n
          GROUP BY a.stock_code, a.date, a.n)""")
def _(shop):
    """The short mean is shown against the long one.

    Its weights are powers of 3/4, so on whole units its plain value often lies
    exactly between two roundings, where the last bit decides. Years after the
    last sale both means are as good as 0 and there is no ratio.
    """
    short, long = F.col("qty_ewma_7"), F.col("qty_ewma_28")
    return feats.add_ewma(shop.sales).select(
        "stock_code", "date", "qty_ewma_28",
        F.when(long > 1e-9, short / long).alias("qty_ewma_7_to_28"),
    )


@query("price_features", {4: "price_change_7d price_vs_avg"}, "sales", """
    SELECT stock_code, date, coalesce(avg_unit_price / lag(avg_unit_price, 7) OVER w - 1, 0) AS price_change_7d,
           coalesce(avg_unit_price / avg(avg_unit_price) OVER (PARTITION BY stock_code ORDER BY date
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS price_vs_avg,
           coalesce(lag(is_promotion) OVER w, 0) AS promotion_lag1,
           sum(is_promotion) OVER (PARTITION BY stock_code ORDER BY date
                                   ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS promotion_roll7
    FROM sales WINDOW w AS (PARTITION BY stock_code ORDER BY date)""")
def _(shop):
    return shop.history.select("stock_code", "date", *feats.price_columns())


@query("momentum_features", {4: "demand_momentum demand_volatility demand_acceleration revenue_vs_28d_avg"},
       "momentum", """
    SELECT stock_code, date, demand_momentum, demand_volatility, demand_acceleration, revenue_vs_28d_avg
    FROM momentum""")
def _(shop):
    return shop.history.select("stock_code", "date", *feats.momentum_columns())


@query("trend_slope", {4: "demand_trend_slope", 2: "revenue_trend"}, "sales", """
    SELECT stock_code, date,
           CASE WHEN n > 14 THEN regr_slope(quantity, n) OVER w ELSE 0 END AS demand_trend_slope,
           CASE WHEN n > 14 THEN regr_slope(revenue, n) OVER w ELSE 0 END AS revenue_trend
    FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY date) AS n FROM sales)
    WINDOW w AS (PARTITION BY stock_code ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)""")
def _(shop):
    return shop.history.select("stock_code", "date", "demand_trend_slope", "revenue_trend")


@query("fourier_features", {6: "sin_week cos_week sin_year cos_year"}, "calendar", """
    SELECT date, sin(2 * pi() * day_of_week / 7) AS sin_week, cos(2 * pi() * day_of_week / 7) AS cos_week,
           sin(2 * pi() * day_of_year / 365) AS sin_year, cos(2 * pi() * day_of_year / 365) AS cos_year
    FROM calendar""")
def _(shop):
    return shop.calendar.withColumns(feats.fourier_columns()).select(
        "date", "sin_week", "cos_week", "sin_year", "cos_year"
    )


@query("lifecycle_features", None, "sales products", """
    SELECT s.stock_code, date, (days_since_launch <= 30)::INT AS is_new_product,
           (days_since_launch > 180)::INT AS is_mature_product,
           sum(quantity) OVER (PARTITION BY s.stock_code ORDER BY date ROWS UNBOUNDED PRECEDING) AS cumulative_qty
    FROM sales s LEFT JOIN products p ON p.stock_code = s.stock_code""")
def _(shop):
    ages = shop.products.select("stock_code", "days_since_launch")
    rows = shop.history.select("stock_code", "date", "cumulative_qty").join(ages, "stock_code", "left")
    return rows.withColumns(feats.lifecycle_columns()).drop("days_since_launch")


@query("feat_join", {2: "revenue inventory_value", 6: "unit_price"}, "sales stock products calendar", """
    SELECT s.stock_code, s.date, s.quantity, s.revenue, s.avg_unit_price AS unit_price,
           c.week_of_year, c.season, c.is_holiday, p.category, p.abc_class, p.lead_time_days,
           p.avg_unit_price AS sku_avg_price, i.closing_inventory, i.reorder_triggered, i.inventory_value
    FROM sales s LEFT JOIN calendar c ON c.date = s.date
    LEFT JOIN products p ON p.stock_code = s.stock_code
    LEFT JOIN stock i ON i.stock_code = s.stock_code AND i.date = s.date""")
def _(shop):
    sales = shop.sales.withColumnRenamed("avg_unit_price", "unit_price")
    return feats.join_attributes(sales, shop.calendar, shop.products, shop.stock).select(
        "stock_code", "date", "quantity", "revenue", "unit_price", "week_of_year", "season",
        "is_holiday", "category", "abc_class", "lead_time_days", "sku_avg_price",
        "closing_inventory", "reorder_triggered", "inventory_value",
    )


@query("inventory_features", {4: "stock_turnover_28 coverage_vs_lead inv_above_rop days_of_supply"},
       "roll stock products", """
    SELECT r.stock_code, r.date,
           coalesce(CASE WHEN n > 14 THEN m28 END * 28 / greatest(closing_inventory, 1), 0) AS stock_turnover_28,
           coverage_days / greatest(lead_time_days, 1) AS coverage_vs_lead,
           closing_inventory - reorder_point AS inv_above_rop, least(coverage_days, 365) AS days_of_supply
    FROM roll r JOIN stock i ON i.stock_code = r.stock_code AND i.date = r.date
    JOIN products p ON p.stock_code = r.stock_code""")
def _(shop):
    return shop.features.select(
        "stock_code", "date", "stock_turnover_28", "coverage_vs_lead", "inv_above_rop", "days_of_supply"
    )


@query("encodings", None, "sales products calendar", """
    SELECT s.stock_code, s.date, CASE abc_class WHEN 'A' THEN 3 WHEN 'B' THEN 2 ELSE 1 END AS abc_encoded,
           (season = 'autumn')::INT AS season_autumn, (season = 'spring')::INT AS season_spring,
           (season = 'summer')::INT AS season_summer, (season = 'winter')::INT AS season_winter,
           k.code AS category_encoded, day_of_week AS dow_encoded
    FROM sales s JOIN products p ON p.stock_code = s.stock_code JOIN calendar c ON c.date = s.date
    JOIN (SELECT category, row_number() OVER (ORDER BY category) - 1 AS code
          FROM (SELECT DISTINCT category FROM products)) k ON k.category = p.category""")
def _(shop):
    return shop.features.select(
        "stock_code", "date", "abc_encoded", "season_autumn", "season_spring", "season_summer",
        "season_winter", "category_encoded", "dow_encoded",
    )


# The parts of the feature table that have their own SQL, and what is missing there counts as 0.
_FEATURE_PARTS = (
    "feat_join", "lag_features", "rolling_features", "price_features", "momentum_features", "trend_slope",
    "lifecycle_features", "inventory_features", "encodings",
)


def _feature_table_query() -> None:
    places: dict[int, list[str]] = {}
    names: list[str] = []
    for part in _FEATURE_PARTS:
        for n, text in QUERIES[part].places.items():
            places.setdefault(n, []).extend(text.split())
        names += [c for c in _FEATURE_COLUMNS[part].split() if c not in names]
    plain = ("stock_code", "date", "quantity", "season", "category", "abc_class")
    fields = ", ".join(c if c in plain else f"coalesce({c}, 0) AS {c}" for c in names)
    joins = " ".join(f"JOIN ({QUERIES[p].sql}) {p} USING (stock_code, date)" for p in _FEATURE_PARTS[1:])
    text = f"SELECT {fields} FROM ({QUERIES[_FEATURE_PARTS[0]].sql}) {_FEATURE_PARTS[0]} {joins}"
    QUERIES["feature_table"] = Query(
        lambda shop: shop.features.select(*names), {n: " ".join(x) for n, x in places.items()}, text
    )


_FEATURE_COLUMNS = {
    "feat_join": "stock_code date quantity revenue unit_price week_of_year season is_holiday category abc_class "
                 "lead_time_days sku_avg_price closing_inventory reorder_triggered inventory_value",
    "lag_features": " ".join(_LAGS),
    "rolling_features": " ".join(
        f"{name}_roll_{stat}_{width}" for name, widths in (("quantity", (7, 14, 28, 56)), ("revenue", (7, 28)))
        for width in widths for stat in ("mean", "median", "std")),
    "price_features": "price_change_7d price_vs_avg promotion_lag1 promotion_roll7",
    "momentum_features": "demand_momentum demand_volatility demand_acceleration revenue_vs_28d_avg",
    "trend_slope": "demand_trend_slope revenue_trend",
    "lifecycle_features": "is_new_product is_mature_product cumulative_qty",
    "inventory_features": "stock_turnover_28 coverage_vs_lead inv_above_rop days_of_supply",
    "encodings": "abc_encoded season_autumn season_spring season_summer season_winter category_encoded dow_encoded",
}


@query("target_correlation", {6: "correlation"}, "pairs", """
    SELECT y AS feature, correlation FROM pairs WHERE x = 'quantity' AND y <> 'quantity' AND correlation IS NOT NULL
    ORDER BY abs(correlation) DESC, feature LIMIT 15""")
def _(shop):
    return quality.top_correlated(shop.history, "quantity", list(HISTORY_NUMBERS), 15)


@query("correlation_matrix", {6: "correlation"}, "pairs", "SELECT x, y, n, correlation FROM pairs")
def _(shop):
    """Of all numbers of the feature history."""
    return quality.correlation_matrix(shop.history, list(HISTORY_NUMBERS))


_RAW_TYPES = {
    "invoice_no": "string", "stock_code": "string", "description": "string", "quantity": "double",
    "invoice_date": "timestamp", "unit_price": "double", "customer_id": "string", "country": "string",
}


@query("raw_missing_report", {2: "null_pct"}, "raw", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, "
    f"count(*) FILTER ({c} IS NULL) / count(*) * 100 AS null_pct, '{t}' AS dtype FROM raw" for c, t in _RAW_TYPES.items()))
def _(shop):
    return quality.missing_report(shop.raw)


_DESCRIBE = """
    SELECT feature, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
           quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q75,
           max(value) AS max, (count(*) - count(value)) / count(*) * 100 AS null_pct
    FROM melted GROUP BY feature"""
_DESCRIBED = {4: "mean std min q25 median q75 max", 2: "null_pct"}


@query("widest_columns", _DESCRIBED, "melted", f"SELECT * FROM ({_DESCRIBE}) ORDER BY std DESC, feature LIMIT 10")
def _(shop):
    return quality.most_variable(quality.column_stats(shop.history, list(HISTORY_NUMBERS)), 10)


@query("correlation_chain", {6: "correlation"}, "pairs", """
    WITH strongest AS (SELECT y AS name FROM pairs WHERE x = 'quantity' AND y <> 'quantity' AND correlation IS NOT NULL
                       ORDER BY abs(correlation) DESC, y LIMIT 15)
    SELECT x, y, n, correlation FROM pairs
    WHERE (x = 'quantity' OR x IN (FROM strongest)) AND (y = 'quantity' OR y IN (FROM strongest))""")
def _(shop):
    return quality.strongest_matrix(shop.history, "quantity", list(HISTORY_NUMBERS), 15)


@query("feature_stats", _DESCRIBED, "melted", _DESCRIBE)
def _(shop):
    return quality.column_stats(shop.history, list(HISTORY_NUMBERS))


_feature_table_query()


def _full_table_query() -> None:
    """All columns of the feature table, joined in SQL from the history, the products, the stock and the calendar.

    The short EWMA is shown against the long one, as in ``ewma_features``.
    """
    history = [c for c in HISTORY_NUMBERS if c != "qty_ewma_7"]
    product = "category lead_time_days moq abc_class days_since_launch supplier warehouse shelf_life_days".split()
    levels = "closing_inventory coverage_days reorder_triggered reorder_point eoq inventory_value avg_daily_demand".split()
    dates = ("year month month_name quarter week_of_year day_of_week day_name day_of_month day_of_year is_weekend is_month_start is_month_end "
             "is_quarter_end is_holiday season is_christmas_season is_black_friday is_cyber_monday days_to_christmas days_to_newyear").split()
    fields = [f"coalesce(w.{c}, 0) AS {c}" for c in history] + [f"p.{c}" for c in product] + [f"s.{c}" for c in levels] + [f"c.{c}" for c in dates]
    text = f"""
    SELECT w.stock_code, w.date, {', '.join(fields)}, p.avg_unit_price AS sku_avg_price,
           CASE WHEN qty_ewma_28 > 1e-9 THEN coalesce(qty_ewma_7, 0) / qty_ewma_28 END AS qty_ewma_7_to_28,
           sin(2 * pi() * day_of_week / 7) AS sin_week, cos(2 * pi() * day_of_week / 7) AS cos_week,
           sin(2 * pi() * day_of_year / 365) AS sin_year, cos(2 * pi() * day_of_year / 365) AS cos_year,
           (days_since_launch <= 30)::INT AS is_new_product, (days_since_launch > 180)::INT AS is_mature_product,
           coalesce(quantity_roll_mean_28 * 28 / greatest(closing_inventory, 1), 0) AS stock_turnover_28,
           coverage_days / greatest(lead_time_days, 1) AS coverage_vs_lead,
           closing_inventory - reorder_point AS inv_above_rop, least(coverage_days, 365) AS days_of_supply,
           CASE abc_class WHEN 'A' THEN 3 WHEN 'B' THEN 2 ELSE 1 END AS abc_encoded, k.code AS category_encoded, day_of_week AS dow_encoded,
           (season = 'autumn')::INT AS season_autumn, (season = 'spring')::INT AS season_spring,
           (season = 'summer')::INT AS season_summer, (season = 'winter')::INT AS season_winter
    FROM wide w JOIN products p ON p.stock_code = w.stock_code JOIN stock s ON s.stock_code = w.stock_code AND s.date = w.date
    JOIN calendar c ON c.date = w.date
    JOIN (SELECT category, row_number() OVER (ORDER BY category) - 1 AS code FROM (SELECT DISTINCT category FROM products)) k
      ON k.category = p.category"""
    places: dict[int, list[str]] = {}
    for part in (*_FEATURE_PARTS, "ewma_features", "fourier_features"):
        for n, names in QUERIES[part].places.items():
            places.setdefault(n, []).extend(c for c in names.split() if c not in places.get(n, []))
    joined = {n: " ".join(names) for n, names in places.items()}

    def build(shop):
        short, long = F.col("qty_ewma_7"), F.col("qty_ewma_28")
        return shop.features.withColumn("qty_ewma_7_to_28", F.when(long > 1e-9, short / long)).drop("qty_ewma_7")

    QUERIES["full_feature_table"] = Query(build, joined, with_parts("wide products stock calendar", rounded(text, joined)))


_full_table_query()


# Stock -----------------------------------------------------------------------------

@query("reorder_policy", {4: "avg_daily_demand reorder_point eoq"}, "policy",
       "SELECT stock_code, d AS avg_daily_demand, lead AS lead_time_days, rop AS reorder_point, eoq FROM policy")
def _(shop):
    return reorder_policy(shop.sales, shop.products).drop("unit_price")


@query("stock_ledger", {4: "opening_inventory units_sold closing_inventory"}, "stock", "SELECT * FROM stock")
def _(shop):
    return shop.stock


@query("latest_inventory", {4: "opening_inventory units_sold closing_inventory"}, "latest",
       "SELECT * FROM latest")
def _(shop):
    return shop.latest_stock


@query("low_stock_alerts", {4: "units_sold closing_inventory"}, "latest", """
    SELECT stock_code, date, units_sold, closing_inventory, reorder_triggered, reorder_point,
           inventory_value, coverage_days FROM latest WHERE closing_inventory <= reorder_point""")
def _(shop):
    return reorder_list(shop.latest_stock).select(
        "stock_code", "date", "units_sold", "closing_inventory", "reorder_triggered",
        "reorder_point", "inventory_value", "coverage_days",
    )


@query("dead_stock", {2: "dead_value"}, "latest", """
    SELECT count(*) FILTER (coverage_days > 365) AS dead,
           count(*) FILTER (coverage_days > 90 AND coverage_days <= 365) AS slow,
           count(*) FILTER (coverage_days <= 90) AS active,
           coalesce(sum(inventory_value) FILTER (coverage_days > 365), 0) AS dead_value FROM latest""")
def _(shop):
    return reports.dead_stock(shop.latest_stock)


@query("inventory_kpis", {2: "total_value", 4: "avg_coverage_days"}, "latest", """
    SELECT count(*) AS skus_tracked, sum(inventory_value) AS total_value,
           avg(coverage_days) AS avg_coverage_days, count(*) FILTER (closing_inventory <= 0) AS zero_stock_skus,
           count(*) FILTER (closing_inventory <= reorder_point) AS below_reorder,
           (SELECT sum(reorder_triggered) FROM stock) AS reorder_events FROM latest""")
def _(shop):
    return reports.inventory_kpis(shop.stock, shop.latest_stock)


@query("coverage_histogram", {4: "bucket_start"}, "stock", """
    SELECT least(floor(least(coverage_days, 365) / 9.125)::INT + 1, 40) AS bucket, count(*) AS n,
           (least(floor(least(coverage_days, 365) / 9.125)::INT + 1, 40) - 1) * 9.125 AS bucket_start
    FROM stock GROUP BY ALL""")
def _(shop):
    return reports.coverage_histogram(shop.stock)


@query("top_overstocked", {4: "closing_inventory"}, "latest products", """
    SELECT l.stock_code, closing_inventory, coverage_days, inventory_value, reorder_point, description, category
    FROM latest l JOIN products p ON p.stock_code = l.stock_code
    ORDER BY coverage_days DESC, l.stock_code LIMIT 20""")
def _(shop):
    return reports.top_overstocked(shop.latest_stock, shop.products)


# Risk ------------------------------------------------------------------------------

@query("demand_stats", {4: "avg_daily_demand std_daily_demand demand_momentum avg_unit_price", 2: "total_revenue"},
       "momentum", """
    SELECT stock_code, avg(quantity) AS avg_daily_demand, stddev_samp(quantity) AS std_daily_demand,
           arg_max(demand_momentum, date) AS demand_momentum, sum(revenue) AS total_revenue,
           avg(unit_price) AS avg_unit_price FROM momentum GROUP BY stock_code""")
def _(shop):
    from larder.operators.risk import demand_stats

    return demand_stats(shop.demand_history)


@query("risk_base", {4: "closing_inventory avg_daily_demand std_daily_demand demand_momentum avg_unit_price"},
       "risk_base", """
    SELECT stock_code, description, category, abc_class, closing_inventory, coverage_days, avg_daily_demand,
           std_daily_demand, demand_momentum, avg_unit_price, lead_time_days FROM risk_base""")
def _(shop):
    return risk_inputs(shop.demand_history, shop.stock, shop.products).select(
        "stock_code", "description", "category", "abc_class", "closing_inventory", "coverage_days",
        "avg_daily_demand", "std_daily_demand", "demand_momentum", "avg_unit_price", "lead_time_days",
    )


_RISK_PLACES = {
    4: "closing_inventory avg_daily_demand avg_unit_price demand_cv demand_momentum stockout_score "
       "overstock_score forecast_qty"
}


@query("risk_scores", _RISK_PLACES, "risk", "SELECT * FROM risk")
def _(shop):
    return shop.risk


@query("risk_every_day", {4: "demand_cv stockout_score overstock_score", 2: "revenue_at_risk capital_locked risk_score"},
       "sales stock products", """
    SELECT stock_code, date, demand_cv, stockout_score, overstock_score,
           stockout_score * 0.60 + overstock_score * 0.40 AS risk_score, risk_level,
           CASE WHEN risk_level LIKE '%Stockout%'
                THEN greatest(14 - coverage_days, 0) * d * price * 2 ELSE 0 END AS revenue_at_risk,
           CASE WHEN risk_level LIKE '%Overstock%' THEN greatest(coverage_days - 60, 0)
                / greatest(coverage_days, 1) * closing_inventory * price ELSE 0 END AS capital_locked
    FROM (SELECT *, CASE WHEN stockout_score >= 75 THEN 'Critical Stockout Risk'
                    WHEN stockout_score >= 50 THEN 'High Stockout Risk'
                    WHEN stockout_score >= 30 THEN 'Moderate Stockout Risk'
                    WHEN overstock_score >= 70 THEN 'Overstock Risk'
                    WHEN overstock_score >= 40 THEN 'Mild Overstock Risk'
                    WHEN demand_cv > 1.5 THEN 'Volatile Demand' ELSE 'Healthy' END AS risk_level
          FROM (SELECT *, least(greatest(CASE WHEN coverage_days <= 0 THEN 100.0
                        WHEN coverage_days < lead THEN 90 - (coverage_days / lead) * 40
                        WHEN coverage_days < 7 THEN 70 - (coverage_days / 7) * 30
                        WHEN coverage_days < 14 THEN 40 - ((coverage_days - 7) / 7) * 20
                        WHEN coverage_days < 30 THEN 20 - (coverage_days / 30) * 15
                        ELSE 5.0 END + least(demand_cv * 10, 20), 0), 100) AS stockout_score,
                   least(greatest(CASE WHEN coverage_days > 365 THEN 90.0
                        WHEN coverage_days > 90 THEN 60 + ((coverage_days - 90) / 275) * 30
                        WHEN coverage_days > 60 THEN 30 + ((coverage_days - 60) / 30) * 30
                        ELSE coverage_days / 60 * 15 END, 0), 100) AS overstock_score
                FROM (SELECT i.stock_code, i.date, i.closing_inventory, i.coverage_days,
                             p.lead_time_days AS lead, s.d, s.sd, s.price,
                             s.sd / greatest(s.d, 0.001) AS demand_cv
                      FROM stock i JOIN products p ON p.stock_code = i.stock_code
                      JOIN (SELECT stock_code, avg(quantity) AS d, stddev_samp(quantity) / 4 AS sd,
                                   avg(avg_unit_price) AS price FROM sales GROUP BY 1) s
                        ON s.stock_code = i.stock_code)))""")
def _(shop):
    """The risk rules on the stock of every day, with a milder spread, to reach all levels."""
    stats = shop.sales.groupBy("stock_code").agg(
        F.avg("quantity").alias("avg_daily_demand"),
        (F.stddev_samp("quantity") / 4).alias("std_daily_demand"),
        F.avg("avg_unit_price").alias("avg_unit_price"),
        F.lit(1.0).alias("demand_momentum"),
    )
    attributes = shop.products.select("stock_code", "abc_class", "lead_time_days")
    rows = (
        shop.stock.select("stock_code", "date", "closing_inventory", "coverage_days")
        .join(stats, "stock_code").join(attributes, "stock_code")
    )
    scored = score_products(rows)
    exact = scored.withColumn(
        "risk_score", F.col("stockout_score") * 0.60 + F.col("overstock_score") * 0.40
    )
    return exact.select(
        "stock_code", "date", "demand_cv", "stockout_score", "overstock_score", "risk_score",
        "risk_level", "revenue_at_risk", "capital_locked",
    )


@query("risk_lookup", _RISK_PLACES, "risk",
       "SELECT * FROM risk WHERE lower(risk_level) = 'critical stockout risk' AND abc_class = 'A'")
def _(shop):
    return lookups.find_risk(shop.risk, "CRITICAL stockout risk", "a")


@query("risk_filtered", _RISK_PLACES, "risk", """
    SELECT * FROM risk WHERE category = 'services' AND coverage_days BETWEEN 0 AND 30
      AND avg_unit_price BETWEEN 1000 AND 10000""")
def _(shop):
    return lookups.filter_risk(
        shop.risk, category="services", coverage=(0.0, 30.0), price=(1000.0, 10000.0)
    )


@query("risk_sheet", None, "risk", """
    SELECT stock_code, description, category, abc_class, risk_level, risk_score, coverage_days, revenue_at_risk, capital_locked,
           priority_score, recommendation FROM risk WHERE category = 'services' AND coverage_days BETWEEN 0 AND 30""")
def _(shop):
    """As the filtered export holds it."""
    return exports.risk_sheet(shop.risk, category="services", coverage=(0.0, 30.0))


@query("action_sheet", None, "risk", """
    SELECT priority_score, stock_code, description, category, abc_class, risk_level, coverage_days, revenue_at_risk, recommendation
    FROM risk ORDER BY priority_score DESC, stock_code LIMIT 50""")
def _(shop):
    return exports.action_sheet(shop.risk)


@query("forecast_sheet", None, "forecast", """
    SELECT stock_code, date::VARCHAR AS date, round(forecast_quantity, 1) AS "Forecast Units" FROM forecast""")
def _(shop):
    return exports.forecast_sheet(_naive_forecast(shop))


@query("top_recommendations", {4: "avg_daily_demand"}, "risk", """
    SELECT row_number() OVER (ORDER BY priority_score DESC, stock_code) AS rank, stock_code, description,
           abc_class, risk_level, risk_score, priority_score, recommendation, revenue_at_risk,
           capital_locked, coverage_days, avg_daily_demand, (SELECT count(*) FROM risk) AS matching_skus
    FROM risk ORDER BY priority_score DESC, stock_code LIMIT 20""")
def _(shop):
    return lookups.top_recommendations(shop.risk)


@query("risk_distribution", None, "risk", "SELECT risk_level, count(*) AS count FROM risk GROUP BY 1")
def _(shop):
    return reports.value_counts(shop.risk, "risk_level")


@query("decision_matrix", None, "risk", """
    SELECT abc_class, count(*) FILTER (risk_level = 'Critical Stockout Risk') AS "Critical Stockout Risk",
           count(*) FILTER (risk_level = 'High Stockout Risk') AS "High Stockout Risk",
           count(*) FILTER (risk_level = 'Moderate Stockout Risk') AS "Moderate Stockout Risk",
           count(*) FILTER (risk_level = 'Overstock Risk') AS "Overstock Risk",
           count(*) FILTER (risk_level = 'Mild Overstock Risk') AS "Mild Overstock Risk",
           count(*) FILTER (risk_level = 'Volatile Demand') AS "Volatile Demand",
           count(*) FILTER (risk_level = 'Healthy') AS "Healthy" FROM risk GROUP BY abc_class""")
def _(shop):
    return reports.decision_matrix(shop.risk)


@query("priority_actions", None, "risk", """
    SELECT priority_score, stock_code, description, category, abc_class, risk_level, coverage_days,
           revenue_at_risk, recommendation FROM risk ORDER BY priority_score DESC, stock_code LIMIT 50""")
def _(shop):
    return reports.priority_actions(shop.risk)


@query("recommendation_groups", {4: "group_priority"}, "risk", """
    SELECT recommendation, row_number() OVER (PARTITION BY recommendation
               ORDER BY priority_score DESC, stock_code) AS position, stock_code, description, category,
           abc_class, risk_score, coverage_days, revenue_at_risk, capital_locked, priority_score,
           count(*) OVER (PARTITION BY recommendation) AS group_skus,
           avg(priority_score) OVER (PARTITION BY recommendation) AS group_priority
    FROM risk QUALIFY position <= 50""")
def _(shop):
    return reports.recommendation_groups(shop.risk)


@query("risk_score_histogram", {4: "bucket_start"}, "risk", """
    SELECT least(floor(risk_score / (100 / 30.0))::INT + 1, 30) AS bucket, count(*) AS n,
           (least(floor(risk_score / (100 / 30.0))::INT + 1, 30) - 1) * (100 / 30.0) AS bucket_start
    FROM risk GROUP BY ALL""")
def _(shop):
    return reports.risk_histogram(shop.risk)


_IMPACT_MONEY = ("revenue_at_risk forecast_revenue_28d inventory_value capital_locked working_capital_saved "
                 "potential_sales_increase overstock_cost_monthly stockout_cost expected_profit_improvement")


@query("business_impact", {2: _IMPACT_MONEY}, "impact", "SELECT * FROM impact")
def _(shop):
    return shop.impact


@query("impact_waterfall", {2: "amount"}, "impact", """
    SELECT 1 AS step, 'Current Revenue at Risk' AS label, 'absolute' AS measure, -revenue_at_risk AS amount FROM impact
    UNION ALL SELECT 2, 'Stockout Recovery', 'relative', potential_sales_increase FROM impact
    UNION ALL SELECT 3, 'Overstock Savings', 'relative', overstock_cost_monthly FROM impact
    UNION ALL SELECT 4, 'Working Capital', 'relative', working_capital_saved FROM impact
    UNION ALL SELECT 5, 'Other', 'relative', 0.0 FROM impact
    UNION ALL SELECT 6, 'Net Benefit', 'total', expected_profit_improvement FROM impact""")
def _(shop):
    return impact_waterfall(shop.impact)


_PRODUCT_MONEY = ("avg_unit_price", "min_price", "max_price", "total_revenue", "total_quantity")


@query("records_json", None, "products", f"""
    SELECT to_json({{'stock_code': stock_code, 'description': description, {', '.join(f"'{c}': {c}::DECIMAL(18, 2)" for c in _PRODUCT_MONEY)},
                    'first_sale_date': strftime(first_sale_date, '%Y-%m-%dT%H:%M:%S'), 'last_sale_date': strftime(last_sale_date, '%Y-%m-%dT%H:%M:%S'),
                    'category': category, 'lead_time_days': lead_time_days, 'moq': moq, 'abc_class': abc_class,
                    'days_since_launch': days_since_launch, 'supplier': supplier, 'warehouse': warehouse,
                    'shelf_life_days': shelf_life_days, 'missing': NULL}})::VARCHAR AS record
    FROM products""")
def _(shop):
    """All columns of the product master."""
    exact = {c: F.col(c).cast("decimal(18,2)") for c in _PRODUCT_MONEY}
    return as_records(shop.products.withColumns(exact | {"missing": F.lit(float("nan"))}))


# Forecasting -----------------------------------------------------------------------

@query("recent_history", None, "sales",
       "SELECT stock_code, date, quantity FROM sales WHERE date >= (SELECT max(date) FROM sales) - 120")
def _(shop):
    return folds.recent_history(shop.sales).select("stock_code", "date", "quantity")


@query("valid_skus", None, "daily", """
    SELECT stock_code, date, quantity FROM daily
    QUALIFY count(*) OVER (PARTITION BY stock_code) >= 60""")
def _(shop):
    return folds.with_min_history(shop.daily, 60).select("stock_code", "date", "quantity")


@query("cv_folds", None, "fold_dates", """
    SELECT (3 - k)::INT AS fold, max(date) FILTER (back = t) AS train_start,
           max(date) FILTER (back > 28 * (k + 1)) AS train_end,
           min(date) FILTER (back <= 28 * (k + 1)) AS test_start,
           max(date) FILTER (back > 28 * k) AS test_end
    FROM fold_dates, (SELECT unnest(range(3)) AS k), (SELECT max(back) AS t FROM fold_dates)
    GROUP BY k""")
def _(shop):
    return folds.cv_folds(shop.sales, folds=3)


def _split(shop):
    """The last fold: 28 test days, everything before for training."""
    newest = shop.span.select("last_date").scalar()
    rows = shop.sales_with_weekday
    cut = F.date_sub(newest, 28)
    return rows.where(F.col("date") <= cut), rows.where(F.col("date") > cut)


@query("seasonal_naive", {6: "predicted"}, "naive", "SELECT stock_code, date, actual, predicted FROM naive")
def _(shop):
    train, test = _split(shop)
    return baselines.seasonal_naive(train, test).select(
        "stock_code", "date", F.col("quantity").alias("actual"), "predicted"
    )


@query("moving_average_forecast", {6: "predicted"}, "moving", "SELECT stock_code, date, actual, predicted FROM moving")
def _(shop):
    train, test = _split(shop)
    return baselines.moving_average(train, test).select(
        "stock_code", "date", F.col("quantity").alias("actual"), "predicted"
    )


def _baseline_metrics(shop):
    train, test = _split(shop)
    rows = [
        maker(train, test).select(
            F.lit(name).alias("model"), F.col("quantity").alias("actual"), "predicted"
        )
        for name, maker in (
            ("SeasonalNaive", baselines.seasonal_naive), ("MovingAverage", baselines.moving_average)
        )
    ]
    return evaluation.forecast_metrics(rows[0].unionByName(rows[1]), ["model"])


@query("forecast_metrics", {4: "WAPE MAPE MAE RMSE Bias MdAPE"}, "metrics", "SELECT * FROM metrics")
def _(shop):
    return _baseline_metrics(shop)


@query("model_ranking", {4: "WAPE MAPE MAE RMSE Bias"}, "metrics", """
    SELECT model, WAPE, MAPE, MAE, RMSE, Bias, row_number() OVER (ORDER BY WAPE, model) AS rank FROM metrics""")
def _(shop):
    return evaluation.rank_models(_baseline_metrics(shop))


@query("best_model", {4: "WAPE"}, "metrics", "SELECT model, WAPE FROM metrics ORDER BY WAPE, model LIMIT 1")
def _(shop):
    return evaluation.best_model(_baseline_metrics(shop))


@query("backtest_errors", {4: "forecast_quantity error abs_error pct_error"}, "naive fold_dates", """
    SELECT stock_code, date, actual AS quantity, predicted AS forecast_quantity, predicted - actual AS error,
           abs(predicted - actual) AS abs_error,
           abs(predicted - actual) / greatest(actual, 0.1) * 100 AS pct_error FROM naive""")
def _(shop):
    train, test = _split(shop)
    made = baselines.seasonal_naive(train, test).select(
        "stock_code", "date", F.col("predicted").alias("forecast_quantity")
    )
    return evaluation.backtest_rows(shop.sales, made)


@query("backtest_summary", {4: "bias std_error mae"}, "naive", """
    SELECT avg(predicted - actual) AS bias, stddev_samp(predicted - actual) AS std_error,
           avg(abs(predicted - actual)) AS mae, count(*) AS n FROM naive""")
def _(shop):
    train, test = _split(shop)
    made = baselines.seasonal_naive(train, test).select(
        "stock_code", "date", F.col("predicted").alias("forecast_quantity")
    )
    return evaluation.backtest_summary(evaluation.backtest_rows(shop.sales, made))


@query("error_histogram", {4: "bucket_start"}, "naive", """
    SELECT least(floor((least(greatest(predicted - actual, -200), 200) + 200) / 8)::INT + 1, 50) AS bucket,
           count(*) AS n,
           -200 + (least(floor((least(greatest(predicted - actual, -200), 200) + 200) / 8)::INT + 1, 50) - 1) * 8.0
               AS bucket_start FROM naive GROUP BY ALL""")
def _(shop):
    train, test = _split(shop)
    errors = baselines.seasonal_naive(train, test).select(
        (F.col("predicted") - F.col("quantity")).alias("error")
    )
    return bucket_counts(errors, "error", -200, 200, 50, clip_low=True)


def _naive_forecast(shop):
    return forecast.naive_next_days(shop.sales_with_weekday)


@query("future_grid", {6: "forecast_quantity"}, "forecast", "SELECT * FROM forecast")
def _(shop):
    return _naive_forecast(shop)


@query("forecast_lookup", {6: "forecast_quantity"}, "forecast", "SELECT * FROM forecast WHERE stock_code = 'RED RING'")
def _(shop):
    return lookups.find_forecast(_naive_forecast(shop), "Red Ring")


@query("forecast_summary", {4: "total_units avg_daily peak_units", 2: "forecast_revenue"}, "forecast products", """
    SELECT f.stock_code, sum(forecast_quantity) AS total_units, avg(forecast_quantity) AS avg_daily,
           max(forecast_quantity) AS peak_units, min(date) FILTER (forecast_quantity = top) AS peak_date,
           any_value(description) AS description, any_value(category) AS category,
           any_value(abc_class) AS abc_class, sum(forecast_quantity) * any_value(avg_unit_price) AS forecast_revenue
    FROM (SELECT *, max(forecast_quantity) OVER (PARTITION BY stock_code) AS top FROM forecast) f
    JOIN products p ON p.stock_code = f.stock_code GROUP BY f.stock_code""")
def _(shop):
    return reports.forecast_summary(_naive_forecast(shop), shop.products)


@query("forecast_band", {4: "value lower upper"}, "forecast", """
    SELECT 'history' AS series, date, value, NULL::DOUBLE AS lower, NULL::DOUBLE AS upper
    FROM (SELECT date, quantity AS value FROM sales WHERE stock_code = 'RED RING' ORDER BY date DESC LIMIT 90)
    UNION ALL SELECT 'forecast', date, forecast_quantity, forecast_quantity * 0.8, forecast_quantity * 1.2
    FROM forecast WHERE stock_code = 'RED RING'""")
def _(shop):
    return reports.forecast_with_history(
        shop.sales, _naive_forecast(shop), "RED RING", band=0.2
    )


@query("forecast_revenue", {4: "forecast_qty", 2: "forecast_revenue"}, "forecast by_product", """
    SELECT b.stock_code, sum(forecast_quantity) AS forecast_qty,
           sum(forecast_quantity) * any_value(avg_price) AS forecast_revenue
    FROM by_product b LEFT JOIN forecast f ON f.stock_code = b.stock_code GROUP BY b.stock_code""")
def _(shop):
    priced = shop.by_product.select("stock_code", F.col("avg_price").alias("avg_unit_price"))
    return add_forecast_revenue(priced, _naive_forecast(shop)).drop("avg_unit_price")


# Models: no SQL counterpart ---------------------------------------------------------

def _model_table(shop):
    return shop.model_table


@query("cv_metrics")
def _(shop):
    return models.cross_validate(_model_table(shop))


@query("feature_importance")
def _(shop):
    table = _model_table(shop)
    return models.feature_importance(shop.spark, models.fit_model(table, "RandomForest"))


@query("rf_forecast")
def _(shop):
    table = _model_table(shop)
    return models.predict(table, models.fit_model(table, "RandomForest"))


@query("forecast_28d")
def _(shop):
    table = _model_table(shop)
    return forecast.forecast_next_days(table, models.fit_model(table, "RandomForest"))


@query("predict_range")
def _(shop):
    table = _model_table(shop)
    model = models.fit_model(table, "RandomForest")
    return forecast.predict_range(
        table, model, ["RED RING", "OLD ROD", "NO SUCH CODE", "RED RING"],
        dt.date(2001, 11, 5), dt.date(2001, 12, 4),
    )


@query("request_grid", None, "sales", """
    SELECT stock_code, d::DATE AS date, month(d) AS month, isodow(d) - 1 AS day_of_week, day(d) AS day_of_month, 0.0::DOUBLE AS quantity
    FROM (SELECT DISTINCT stock_code FROM sales)
    CROSS JOIN (SELECT unnest(generate_series(last + 1, last + 28, INTERVAL 1 DAY)) AS d FROM (SELECT max(date) AS last FROM sales))""")
def _(shop):
    """All products for the four weeks after the last sale, asked for with repeats and a code that there isn't."""
    codes = [row["stock_code"] for row in shop.products.select("stock_code").collect()]  # a request is a list of codes
    last = shop.span.first()["last_date"]
    first, end = last + dt.timedelta(days=1), last + dt.timedelta(days=28)
    asked = forecast.check_request([*codes, "NO SUCH CODE", codes[0]], first, end)
    rows = forecast.request_rows(shop.history, asked, first, end)
    return rows.select("stock_code", "date", "month", "day_of_week", "day_of_month", "quantity")


@query("model_inputs", {4: "quantity_roll_std_28"}, "roll", """
    SELECT stock_code, date, coalesce(lag(quantity, 35) OVER (PARTITION BY stock_code ORDER BY date), 0) AS quantity_lag35,
           coalesce(CASE WHEN n > 14 THEN s28 END, 0) AS quantity_roll_std_28, 0.0::DOUBLE AS no_such_feature,
           greatest(quantity, 0) AS target
    FROM roll""")
def _(shop):
    names = ["quantity_lag35", "quantity_roll_std_28", "no_such_feature"]
    return models.model_input(shop.history, names).select("stock_code", "date", *names, "target")


@query("sku_trend_seasonal")
def _(shop):
    return forecast.trend_seasonal(shop.sales)


_GROUP_MARKS = " UNION ALL ".join(
    f"SELECT '{group}' AS feature_group, '{mark}' AS mark" for group, marks in feats.FEATURE_GROUPS.items() for mark in marks)


@query("feature_group_strength", {6: "mean_strength max_strength"}, "pairs", f"""
    SELECT feature_group, count(*) AS features, avg(abs(correlation)) AS mean_strength, max(abs(correlation)) AS max_strength
    FROM (SELECT DISTINCT feature_group, y, correlation FROM pairs JOIN ({_GROUP_MARKS}) ON contains(y, mark)
          WHERE x = 'quantity' AND y <> 'quantity' AND correlation IS NOT NULL) GROUP BY feature_group""")
def _(shop):
    """How strongly the features of each group go with the quantity."""
    groups = feats.feature_groups(list(HISTORY_NUMBERS))
    strength = quality.target_correlation(shop.history, "quantity", list(HISTORY_NUMBERS))
    return quality.group_strength(strength, groups)


@query("odd_headers_tx", None, "", f"""
    SELECT day AS date, count(*) AS line_count, sum(quantity)::DOUBLE AS quantity, sum(quantity * unit_price)::DOUBLE AS revenue
    FROM (SELECT DISTINCT invoice_no, upper(trim(stock_code)) AS stock_code, lower(trim(description)) AS description, quantity, unit_price, day
          FROM ({_TEXT_LINES}) WHERE NOT ({' OR '.join(_BROKEN)})) GROUP BY day""")
def _(shop):
    """Clean lines by day from a file whose headers have other spellings, case and blanks."""
    odd = {"invoice_no": " Invoice ", "stock_code": "SKU", "description": "Product Name", "quantity": "QTY", "invoice_date": " Date", "unit_price": "Unit Price"}
    tx = clean_transactions(canonical_names(_text_lines(shop).withColumnsRenamed(odd)), CleaningRules(country=None))
    return tx.groupBy("date").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue")
    )


from checks import demand  # noqa: E402, F401
