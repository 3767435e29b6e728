import datetime as dt
import re

from larder import schemas
from larder.config import CleaningRules
from larder.functions.text import product_category, title_case
from larder.operators.cleaning import canonical_names, clean_transactions, format_shape, rejected_lines, time_of
from pyspark.sql import functions as F

UK = "United Kingdom"


def line(invoice="536365", code="85123A", text="red mug", qty="6", when="12/1/2010 8:26",
         price="2.55", customer="17850", country=UK):
    return (invoice, code, text, qty, when, price, customer, country)


def cleaned(spark, rows, rules=CleaningRules()):
    return clean_transactions(spark.createDataFrame(rows, schemas.RAW_LINES), rules).collect()


def test_rows_that_are_dropped(spark):
    rows = [
        line(invoice="C536379"), line(code="POST"), line(code=" DOT "), line(code="gift"),
        line(qty="-1"), line(qty="0"), line(qty="abc"), line(price="0"), line(price=None),
        line(when="not a date"), line(when=None), line(code=None), line(country="France"),
    ]
    assert cleaned(spark, rows) == []


def test_rows_that_are_kept(spark):
    rows = [line(invoice="c1"), line(code="post"), line(text=None), line(customer=None)]
    result = {r["invoice_no"] + r["stock_code"]: r for r in cleaned(spark, rows)}
    assert "c185123A" in result and "536365POST" in result
    assert {r["description"] for r in result.values()} >= {"Red Mug"}


def test_missing_description_becomes_text(spark):
    assert cleaned(spark, [line(text=None)])[0]["description"] == "Nan"


def test_derived_columns_and_duplicates(spark):
    rows = [line(), line(), line(code=" 85123a "), line(text="RED MUG")]
    (row,) = cleaned(spark, rows)
    assert row["stock_code"] == "85123A"
    assert row["date"] == dt.date(2010, 12, 1)
    assert row["invoice_date"] == dt.datetime(2010, 12, 1, 8, 26)
    assert abs(row["revenue"] - 15.3) < 1e-9


def test_no_country_column_means_no_country_filter(spark):
    raw = spark.createDataFrame([line(country="France")], schemas.RAW_LINES).drop("country")
    assert clean_transactions(raw).count() == 1


def test_headers(spark):
    df = spark.createDataFrame([(1,) * 5], "`Invoice` int, ` Unit Price ` int, StockCode int, "
                                           "`Customer ID` int, extra int")
    assert canonical_names(df).columns == [
        "invoice_no", "unit_price", "stock_code", "customer_id", "extra"
    ]


def test_title_case_equals_python(spark):
    texts = ["t-light don't 3x box", "RED  mug", "ÉCLAIR à la crème", "a/b_c 12th", "", "x1y2 Z",
             "white.hanging HEART", "tab\there"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", title_case(F.col("t")).alias("x")).collect()
    assert {r["t"]: r["x"] for r in rows} == {t: t.title() for t in texts}


def test_categories(spark):
    cases = {
        ("Red Mug", "1"): "kitchen", ("Paper Bag", "1"): "gifts", ("Alarm", "1"): "services",
        ("Nan", "21000"): "home_decor", ("Nan", "35000"): "gifts", ("Nan", "60000"): "kitchen",
        ("Nan", "84000"): "storage", ("Nan", "85123A"): "miscellaneous", ("Nan", "7"): "home_decor",
        (None, "21000"): "miscellaneous",
    }
    df = spark.createDataFrame(list(cases), "d string, c string")
    rows = df.select("d", "c", product_category(F.col("d"), F.col("c")).alias("k")).collect()
    assert {(r["d"], r["c"]): r["k"] for r in rows} == cases


def test_numbers_that_are_no_numbers(spark):
    bad = ["NaN", "nan", "2d", "1f", "0x1", "", " ", "1,5", "--1", None]
    assert cleaned(spark, [line(qty=x) for x in bad] + [line(price=x) for x in bad]) == []
    good = {" 17 ": 17.0, "1e1": 10.0, "+3": 3.0, ".5": 0.5, "4.": 4.0}
    rows = cleaned(spark, [line(invoice=str(i), qty=x) for i, x in enumerate(good)])
    assert sorted(r["quantity"] for r in rows) == sorted(good.values())
    typed = spark.createDataFrame([(1, "A", "x", float("nan"), dt.datetime(2011, 1, 1), 2.0)],
                                  "invoice_no int, stock_code string, description string, "
                                  "quantity double, invoice_date timestamp, unit_price double")
    assert clean_transactions(typed).count() == 0


def test_rejected_lines_are_counted_by_reason(spark):
    rows = [
        line(), line(invoice="C1"), line(invoice="C2", qty="0"), line(code=None), line(code="POST"),
        line(country="France"), line(country=None), line(when="31.12.1999"), line(qty="NaN"), line(price="-1"), line(),
    ]
    raw = spark.createDataFrame(rows, schemas.RAW_LINES)
    got = {r["reason"]: r["line_count"] for r in rejected_lines(raw).collect()}
    assert got == {
        "cancelled": 2, "no_stock_code": 1, "not_a_product": 1, "other_country": 2, "unreadable_date": 1,
        "quantity_not_positive": 1, "price_not_positive": 1,
    }
    assert sum(got.values()) + 2 == len(rows)


def test_formats_are_only_tried_on_text_of_their_shape():
    formats = CleaningRules().timestamp_formats
    texts = ["12/1/2010 8:26", "12/1/2010 8:26:05", "12/1/2010", "2010-12-01 08:26:05", "2010-12-01 08:26", "2010-12-01", "2010-12-01T08:26:05"]
    for text, own in zip(texts, formats, strict=True):
        assert [f for f in formats if re.search(format_shape(f), text)] == [own]
    assert not any(re.search(format_shape(f), x) for f in formats for x in ("31.12.1999", "", "nan", "2010-12"))
    assert [format_shape(f) for f in ("d MMM yyyy", "yyyy-MM-dd[ HH:mm]", "HH 'o''clock'", "yyyy-MM-dd HH:mm:ss.SSS", "M/d/yyyy h:mm a")] == [None] * 5


def test_shapes_change_no_time(spark):
    """Against each format tried on every text."""
    formats = (*CleaningRules().timestamp_formats, "yyyyMMdd", "d MMM yyyy", "dd.MM.yyyy 'um' HH:mm", "yyyy-MM-dd[ HH]")
    texts = ["12/1/2010 8:26", " 12/1/2010 8:26:05 ", "012/01/2010", "13/1/2010", "2/30/2010", "2010-12-01 08:26:05", "2010-12-01t08:26:05", "2010-12-01T08:26:05",
             "2010-12-01 08:26", "2010-12-01 8:26", "2010-12-01", "2010-02-29", "2012-02-29", "+12010-12-01", "12010-12-01", "-2010-12-01", "0000-01-01", "2010-12-01 24:00:00",
             "2010-12-01\n", "2010-12-01  08:26", "20101201", "1 Dec 2010", "1 dec 2010", "01.12.2010 UM 08:26", "01.12.2010 um 8:26", "2010-12-01 08", "\u0661/1/2010", "12/1/10", "", " ", "nan", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, invoice_date string")
    plain = F.coalesce(*[F.try_to_timestamp(F.trim("invoice_date"), F.lit(f)) for f in formats])
    rows = df.select("invoice_date", F.unix_micros(time_of(df, CleaningRules(timestamp_formats=formats))).alias("got"), F.unix_micros(plain).alias("wanted")).collect()
    assert [r for r in rows if r["got"] != r["wanted"]] == []
    assert sum(r["wanted"] is not None for r in rows) >= 12


def test_text_is_read_once(spark):
    """Neither the filter nor the counts work out again what the projection has."""
    raw = spark.createDataFrame([line()], schemas.RAW_LINES)
    text = raw.withColumn("invoice_date", F.concat("invoice_date", F.lit("")))
    for made in (clean_transactions(text), rejected_lines(text)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("M/d/yyyy H:mm:ss") == 1
