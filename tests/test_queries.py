"""Some registered queries against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
CHECKED = (
    "clean_tx", "title_case", "category_rule", "daily_agg", "sku_master", "calendar", "abc_summary",
    "promo_impact", "ewma_features", "trend_slope", "stock_ledger", "risk_scores", "business_impact",
    "cv_folds", "forecast_metrics", "clean_text_tx", "rejected_lines", "description_mode", "top_skus", "request_grid",
    "raw_missing_report", "correlation_chain", "feature_stats", "feature_group_strength", "schema_report", "records_json",
    "missing_report", "full_feature_table", "cohort_retention", "rfm_scores", "price_percentile", "promotion_lift",
    "year_ago_demand", "conformal_radius", "interval_coverage", "safety_stock", "risk_sheet", "abc_xyz", "odd_headers_tx",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (int, float)):
        return None if math.isnan(value) else float(value) + 0.0
    return value if value is None else str(value).removesuffix("+00:00")


def table(rows, columns, names):
    order = [columns.index(n) for n in names]
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


@pytest.mark.parametrize("name", CHECKED)
def test_same_answer(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    names = sorted(columns)
    assert table(df.collect(), df.columns, names) == table(cursor.fetchall(), columns, names)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
