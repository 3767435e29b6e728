import datetime as dt
import glob
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder import schemas
from larder.operators.cleaning import clean_transactions
from larder.operators.folds import recent_history
from larder.operators.quality import missing_report, quality_overview, schema_report
from larder.plans.full_run import Settings, full_run
from larder.config import CleaningRules, ForecastRules
from larder.functions.numbers import half_up
from larder.plans.lineage import checkpoint_dir, pin, pins_released
from larder.plans import exports
from larder.sources import tables, tpch

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
TEXT = '1,85123A,"BOX, £5 ""SALE""",6,12/1/2010 8:26,2.55,17850,United Kingdom\n'


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_raw_csv_in_either_encoding(spark, tmp_path, encoding):
    (tmp_path / "raw.csv").write_bytes((HEADER + TEXT).encode(encoding))
    row = tables.read_raw_lines(spark, str(tmp_path)).first()
    assert row["description"] == 'BOX, £5 "SALE"' and row["unit_price"] == "2.55"


def test_each_file_has_its_own_encoding(spark, tmp_path):
    for name, encoding in (("a [1].csv", "utf-8"), ("b.csv", "latin-1")):
        (tmp_path / name).write_bytes((HEADER + TEXT.replace("BOX", name[0])).encode(encoding))
    got = sorted(r["description"] for r in tables.read_raw_lines(spark, str(tmp_path)).collect())
    assert got == ['a, £5 "SALE"', 'b, £5 "SALE"']


def test_line_breaks_in_fields_and_malformed_lines(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(HEADER + TEXT.replace("BOX", "BIG\nBOX") + "2,85123A\n" + TEXT)
    whole = tables.read_raw_lines(spark, str(tmp_path), multi_line=True)
    assert [r["description"] for r in whole.collect()] == ['BIG\nBOX, £5 "SALE"', None, 'BOX, £5 "SALE"']
    bad = tables.malformed_lines(spark, str(tmp_path), multi_line=True)
    assert [r["line"] for r in bad.collect()] == ["2,85123A"]
    assert tables.malformed_lines(spark, str(tmp_path)).count() == 3


def test_a_history_cut_reads_recent_months_only(spark, tmp_path):
    days = spark.range(900).select(
        F.concat(F.lit("p"), F.col("id") % 50).alias("stock_code"),
        F.date_add(F.lit("2010-01-01"), (F.col("id") % 450).cast("int")).alias("date"),
    )
    tables.write_features(days, str(tmp_path / "f"), files_per_month=3)
    assert all(len(list(p.glob("*.parquet"))) <= 3 for p in (tmp_path / "f").glob("sale_month=*"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    cut = recent_history(stored, 40)
    assert sorted(cut.select("stock_code", "date").collect()) == sorted(recent_history(days, 40).collect())
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_month" in plan and "sale_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_files_of_a_month_follow_its_size(spark, tmp_path):
    """Small months are a file each; a month beyond the advisory size is several, each in order."""
    days = spark.range(60_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("stock_code"),
        F.date_add(F.lit("2010-01-01"), F.when(F.col("id") < 55_000, 5).otherwise(F.col("id") % 90).cast("int")).alias("date"),
    )
    count = lambda name, month: len(list((tmp_path / name / f"sale_month={month}").glob("*.parquet")))
    tables.write_features(days, str(tmp_path / "small"))
    assert [count("small", f"2010-0{m}") for m in (1, 2, 3)] == [1, 1, 1]
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500KB")
    try:
        tables.write_features(days.repartition(8), str(tmp_path / "large"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert count("large", "2010-01") > 3 and count("large", "2010-03") == 1
    stored = spark.read.parquet(str(tmp_path / "large")).drop("sale_month")
    assert stored.count() == 60_000 and stored.exceptAll(days).isEmpty()
    for file in (tmp_path / "large" / "sale_month=2010-01").glob("*.parquet"):
        rows = [(r.stock_code, r.date) for r in spark.read.parquet(str(file)).collect()]
        assert rows == sorted(rows)


def test_sheets_are_exported_and_read_back(spark, tmp_path):
    risk = spark.createDataFrame(
        [(f"p{k}", 'odd "name", with comma', "home" if k % 2 else "toys", "A", "Healthy", 1.5, float(k), 10.0, float(k % 7), "do, it") for k in range(30)],
        "stock_code string, description string, category string, abc_class string, risk_level string, risk_score double, "
        "coverage_days double, avg_unit_price double, priority_score double, recommendation string")
    forecast = spark.createDataFrame([("p1", dt.date(2020, 1, 1), 1.25), ("p2", dt.date(2020, 1, 2), 3.0)], "stock_code string, date date, forecast_quantity double")
    paths = exports.export_sheets(risk, forecast, str(tmp_path), n=5, category="home", coverage=(3.0, 20.0))
    read = {p.rsplit("/", 1)[1]: spark.read.option("header", True).option("escape", '"').csv(p).collect() for p in paths}
    assert [r["Forecast Units"] for r in sorted(read["forecast"])] == ["1.3", "3.0"]
    assert sorted(r.stock_code for r in read["risk_scores"]) == sorted(f"p{k}" for k in range(3, 21, 2))
    assert read["risk_scores"][0].description == 'odd "name", with comma' and "avg_unit_price" not in read["risk_scores"][0].asDict()
    best = sorted(range(30), key=lambda k: (-(k % 7), f"p{k}"))[:5]
    assert [r.stock_code for r in read["priority_actions"]] == [f"p{k}" for k in best]
    assert len(read["recommendations"]) == 15 and len(list((tmp_path / "priority_actions").glob("*.csv"))) == 1


def test_stored_tables_have_their_declared_columns(spark):
    df = spark.createDataFrame([(1, "a", "extra")], "forecast_quantity int, stock_code string, more string")
    with pytest.raises(ValueError, match="lacks date"):
        tables.conform(df, schemas.FORECAST_OUTPUT, "forecast")
    whole = df.withColumn("date", F.lit("2011-01-02"))
    assert tables.conform(whole, schemas.FORECAST_OUTPUT, "forecast").dtypes == [
        ("stock_code", "string"), ("date", "date"), ("forecast_quantity", "double")]


def test_pins_go_with_their_block(spark):
    with pins_released(spark):
        kept = pin(spark.range(5))
        (path,) = {os.path.dirname(f) for f in kept.inputFiles()}
        assert kept.count() == 5
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.date(2011, 1, 1), 2.0)], schemas.FORECAST_OUTPUT)
    for kind in ("parquet", "csv"):
        tables.write_table(df, f"{tmp_path}/{kind}", kind)
        got = tables.read_table(spark, f"{tmp_path}/{kind}", schemas.FORECAST_OUTPUT, kind)
        assert got.collect() == df.collect()
    empty = tables.read_table(spark, f"{tmp_path}/none", schemas.FORECAST_OUTPUT, required=False)
    assert empty.count() == 0 and empty.columns == df.columns
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, f"{tmp_path}/none", schemas.FORECAST_OUTPUT)
    tables.export_csv(df, f"{tmp_path}/one", single_file=True)
    assert tables.preview(spark, f"{tmp_path}/one").count() == 1


def test_records(spark):
    df = spark.createDataFrame([("a", float("nan"), dt.datetime(2011, 1, 1, 2, 3), None)],
                               "k string, v double, t timestamp, n int")
    record = json.loads(tables.as_records(df).first()["record"])
    assert record == {"k": "a", "v": None, "t": "2011-01-01T02:03:00", "n": None}


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "Invoice string, qty int")
    row = quality_overview(df).first()
    assert (row["row_count"], row["avg_null_pct"], row["duplicate_pct"]) == (4, 25.0, 25.0)
    got = {r["column_name"]: (r["null_count"], r["null_pct"]) for r in missing_report(df).collect()}
    assert got == {"Invoice": (1, 25.0), "qty": (1, 25.0)}
    found = {r["required_column"]: (r["status"], r["matched_as"]) for r in schema_report(df).collect()}
    assert found["InvoiceNo"] == ("Found", "Invoice") and found["Country"] == ("Missing", None)


def test_full_run_without_training(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    raw = tpch.invoice_lines(spark, folder)
    settings = Settings(cleaning=CleaningRules(country=None))
    summary = full_run(raw, tpch.supply_terms(spark, folder), str(tmp_path), settings, skip_training=True).first()
    assert summary["sales_daily_rows"] == summary["sku_count"] * (
        (summary["last_date"] - summary["first_date"]).days + 1)
    assert summary["total_skus"] == summary["sku_count"] == summary["business_impact"]["total_skus"]
    assert summary["feature_columns"] == 103  # 102 and the month folder
    stored = spark.read.parquet(f"{tmp_path}/features")
    plan = stored.where(F.col("sale_month") == "2001-10")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_month" in plan
    assert tables.read_json(spark, f"{tmp_path}/business_impact_json", "total_skus bigint").first()[0] == summary["total_skus"]
    for name in ("sales_daily_agg", "sku_sales_agg", "sales_weekly_agg", "category_agg", "low_stock_alerts"):
        assert spark.read.parquet(f"{tmp_path}/{name}").count() > 0


def test_full_run_with_training_and_given_stock(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    raw = tpch.invoice_lines(spark, folder, buyers=False).withColumns(
        {"customer_id": F.lit(None).cast("string"), "country": F.lit("x")})
    first = raw.agg(F.min("invoice_date")).first()[0]
    raw = raw.where(F.col("invoice_date") < F.lit(first + dt.timedelta(days=250)))
    terms = tpch.supply_terms(spark, folder)
    codes = terms.select("stock_code")
    stock = codes.select(
        "stock_code", F.lit(first.date()).alias("date"), F.lit(5.0).alias("opening_inventory"),
        F.lit(1.0).alias("units_sold"), F.lit(4.0).alias("closing_inventory"), F.lit(1).alias("reorder_triggered"),
        F.lit(9.0).alias("reorder_point"), F.lit(12.0).alias("eoq"), F.lit(40.0).alias("inventory_value"),
        F.lit(3.0).alias("coverage_days"), F.lit(1.5).alias("avg_daily_demand"))
    rules = ForecastRules(horizon=7, models=("RandomForest", "SampledBoosting"), features=("quantity_lag1", "day_of_week", "unit_price"))
    settings = Settings(cleaning=CleaningRules(country=None), forecast=rules)
    pins = lambda: {p for p in glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/pinned-*")}
    before = pins()
    summary = full_run(raw, terms, str(tmp_path), settings, stock=stock).first()
    assert summary["forecast_rows"] == 7 * summary["sku_count"]
    assert {m["model"] for m in summary["models"]} == {"RandomForest", "SampledBoosting", "SeasonalNaive"}
    assert spark.read.parquet(f"{tmp_path}/inventory_snapshots").count() == codes.count()
    assert pins() == before


def test_lines_are_shuffled_once_by_invoice_and_keep_all_buyers(spark, tmp_path):
    """Repeated lines, orders with two buyers or none, and missing keys, against cleaning after all joins."""
    day = dt.datetime(1995, 1, 2)
    lines = [(1, 1, 2.0, 10.0, "N", day), (1, 1, 2.0, 10.0, "N", day), (1, 2, 2.0, 10.0, "N", day), (1, 3, 1.0, 5.0, "R", day),
             (2, 3, 1.0, 5.0, "A", day), (2, 9, 1.0, 5.0, "N", day), (3, 1, 1.0, 7.0, "N", day), (None, 1, 1.0, 7.0, "N", day), (4, None, 1.0, 7.0, "N", day),
             (5, 2, None, 7.0, "N", day), (5, 2, 1.0, 7.0, None, None), (6, 4, 1.0, 7.0, None, day), (7, 1, -1.0, 7.0, "N", day)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp"),
        "part": ([(1, "red mug", "B1"), (1, "red mug", "B1"), (2, " Red Mug", "B2"), (3, "old rod", "B1"), (4, None, "B1")], "p_partkey long, p_name string, p_brand string"),
        "orders": ([(1, 1), (1, 2), (1, 2), (2, 3), (3, 8), (None, 1), (5, 1), (6, None), (6, 2), (7, 1)], "o_orderkey long, o_custkey long"),
        "customer": ([(1, 1), (2, 1), (2, 2), (3, 3), (None, 1)], "c_custkey long, c_nationkey int"),
        "nation": ([(1, "X"), (2, "Y"), (2, "Y"), (3, None)], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    made = tpch.transactions(spark, str(tmp_path))
    after = clean_transactions(tpch.invoice_lines(spark, str(tmp_path)), tpch.RULES)
    assert made.columns == after.columns and made.dtypes == after.dtypes
    assert Counter(made.collect()) == Counter(after.collect())
    assert made.count() == 4 and None in {r["country"] for r in made.collect()}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "unit_price" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_prices_are_rounded_without_decimals(spark, tmp_path):
    """As round does, which parses a decimal for every line; a line's price is worked out once a filter."""
    odd = [0.0, -0.0, 0.5, -0.5, 1.5, -1.5, 2.5, -2.5, 0.3, -0.3, 0.49999999999999994, -0.49999999999999994, 1e300, -1e300, 5e-324,
           4503599627370495.5, 4503599627370497.0, 9007199254740993.0, float("inf"), float("-inf"), float("nan"), None]
    values = odd + [n / 8 for n in range(-400, 400)] + [10.0 * n / 7 for n in range(500)]
    both = spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 0).alias("a"), half_up(F.col("v")).alias("b"))
    assert [str(r["b"]) for r in both.collect()] == [str(r["a"]) for r in both.collect()]
    tx = tpch.transactions(spark, "/root/testdata/sf0.001")
    plan = tx._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan
    filters = [x for x in plan.splitlines() if "Filter" in x and "l_extendedprice" in x]
    assert filters and all("isnan" not in x for x in filters)
