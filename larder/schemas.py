"""Declared schemas of the stored tables."""

from __future__ import annotations

RAW_LINES = (
    "invoice_no string, stock_code string, description string, quantity string, "
    "invoice_date string, unit_price string, customer_id string, country string"
)
SALES_DAILY = (
    "stock_code string, date date, quantity double, revenue double, avg_unit_price double, "
    "num_orders bigint, num_customers bigint, is_promotion int"
)
SKU_MASTER = (
    "stock_code string, description string, avg_unit_price double, min_price double, "
    "max_price double, total_revenue double, total_quantity double, first_sale_date timestamp, "
    "last_sale_date timestamp, category string, lead_time_days int, moq int, abc_class string, "
    "days_since_launch int, supplier string, warehouse string, shelf_life_days int"
)
CALENDAR = (
    "date date, year int, month int, month_name string, quarter int, week_of_year int, "
    "day_of_week int, day_name string, day_of_month int, day_of_year int, is_weekend int, "
    "is_month_start int, is_month_end int, is_quarter_end int, is_holiday int, season string, "
    "is_christmas_season int, is_black_friday int, is_cyber_monday int, "
    "days_to_christmas int, days_to_newyear int"
)
INVENTORY_SNAPSHOTS = (
    "stock_code string, date date, opening_inventory double, units_sold double, "
    "closing_inventory double, reorder_triggered int, reorder_point double, eoq double, "
    "inventory_value double, coverage_days double, avg_daily_demand double"
)
FORECAST_OUTPUT = "stock_code string, date date, forecast_quantity double"
MODEL_COMPARISON = (
    "model string, WAPE double, MAPE double, MAE double, RMSE double, Bias double, rank int"
)
RISK_SCORES = (
    "stock_code string, description string, category string, abc_class string, "
    "closing_inventory double, coverage_days double, reorder_point double, eoq double, "
    "avg_daily_demand double, avg_unit_price double, lead_time_days int, demand_cv double, "
    "demand_momentum double, stockout_score double, overstock_score double, risk_score double, "
    "risk_level string, revenue_at_risk double, capital_locked double, priority_score double, "
    "recommendation string, forecast_qty double, forecast_revenue double, inventory_value double"
)
SUPPLY_TERMS = (
    "stock_code string, lead_time_days int, moq int, supplier string, warehouse string, "
    "shelf_life_days int"
)
TABLES = {
    "sales_daily": SALES_DAILY,
    "sku_master": SKU_MASTER,
    "calendar": CALENDAR,
    "inventory_snapshots": INVENTORY_SNAPSHOTS,
    "forecast_output": FORECAST_OUTPUT,
    "model_comparison": MODEL_COMPARISON,
    "risk_scores": RISK_SCORES,
}
