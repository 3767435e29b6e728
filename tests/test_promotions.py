import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from larder.operators.intervals import conformal_radius, interval_report, split_folds, with_band
from larder.operators.promotions import calendar_features, matched_promotions, promotion_lift
from larder.operators.weekly import WeeklyDemand, weekly_demand, with_zero_weeks

DAILY = "stock_code string, date date, quantity double, is_promotion int"
DAY = dt.timedelta(days=1)


def gappy(rng, products=3, days=500):
    start = dt.date(2020, 1, 1)
    return [
        (f"p{k}", start + n * DAY, float(rng.randrange(30)), int(rng.random() < 0.15))
        for k in range(products) for n in range(days) if rng.random() < 0.6
    ]


def test_controls_and_lift_equal_plain_search(spark):
    rows = gappy(random.Random(1))
    got = {(r.stock_code, r.date): (r.control_date, r.control_quantity) for r in matched_promotions(spark.createDataFrame(rows, DAILY), 3).collect()}
    expected = {}
    for code, day, _, promoted in rows:
        earlier = [(d, q) for c, d, q, p in rows if c == code and not p and dt.timedelta(0) < day - d <= 21 * DAY and d.weekday() == day.weekday()]
        if promoted and earlier:
            expected[code, day] = max(earlier)
    assert got == expected
    quantity = {(c, d): q for c, d, q, _ in rows}
    lift = promotion_lift(matched_promotions(spark.createDataFrame(rows, DAILY), 3), ["stock_code"]).collect()
    for r in lift:
        own = [quantity[k] - v[1] for k, v in expected.items() if k[0] == r.stock_code]
        assert r.promotion_days == len(own) and r.lift == pytest.approx(statistics.mean(own))
        assert r.lift_error == pytest.approx(statistics.stdev(own) / len(own) ** 0.5)
    assert matched_promotions(spark.createDataFrame([], DAILY)).count() == 0


def test_calendar_frames_skip_missing_days(spark):
    rows = gappy(random.Random(2))
    known = {(c, d): q for c, d, q, _ in rows}
    for r in calendar_features(spark.createDataFrame(rows, DAILY)).collect():
        year = r.date - 364 * DAY
        assert r.quantity_lag_52w == known.get((r.stock_code, year))
        around = [known[r.stock_code, year + k * DAY] for k in range(-3, 4) if (r.stock_code, year + k * DAY) in known]
        assert r.quantity_mean_52w == (pytest.approx(sum(around) / len(around)) if around else None)
        before = [d for c, d, _, p in rows if c == r.stock_code and p and d < r.date]
        assert r.weeks_since_promotion == ((r.date - max(before)).days // 7 if before else None)


def test_radius_and_coverage_equal_sorting(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), float(rng.randrange(9)), rng.random() * 9) for _ in range(300)] + [("one", 3.0, 1.0), ("a", None, 2.0)]
    df = spark.createDataFrame(rows, "k string, actual double, predicted double")
    radius = {r.k: (r.radius, r.residuals) for r in conformal_radius(df, ["k"], 0.8).collect()}
    for k in ("a", "b", "one"):
        own = sorted(round(abs(a - p), 6) for x, a, p in rows if x == k and a is not None)
        rank = min(-(-(len(own) + 1) * 8 // 10), len(own))
        assert radius[k] == (own[rank - 1], len(own))
    new = spark.createDataFrame([("a", 4.0, 4.5), ("a", 99.0, 1.0), ("a", 0.0, 0.0), ("no", 1.0, 1.0)], "k string, actual double, predicted double")
    report = {r.k: r for r in interval_report(with_band(new, conformal_radius(df, ["k"], 0.8), ["k"]), ["k"]).collect()}
    assert report["a"].coverage_pct == pytest.approx(200 / 3) and report["no"].banded_rows == 0
    assert report["a"].SMAPE == pytest.approx((2 * 0.5 / 8.5 + 2 * 98 / 100 + 0) / 3 * 100)


def test_band_covers_new_days_of_the_same_kind(spark):
    """Independent days of the same kind: the share inside is near the level."""
    rng, start = random.Random(4), dt.date(2020, 1, 6)
    rows = [(f"p{k}", start + n * DAY, float(rng.randrange(20))) for k in range(40) for n in range(168)]
    calibration, held = split_folds(spark.createDataFrame(rows, "stock_code string, date date, quantity double"))
    assert calibration.count() == held.count() == 40 * 28
    assert {r.step for r in held.select("step").distinct().collect()} == set(range(1, 29))
    radius = conformal_radius(calibration.withColumn("all", F.lit(1)), ["all"], 0.9)
    report = interval_report(with_band(held.withColumn("all", F.lit(1)), radius, ["all"]), ["all"]).first()
    assert 86 < report.coverage_pct < 94


LINES = "stock_code string, date date, quantity double, revenue double, invoice_no string"


def test_batches_give_what_a_rebuild_gives(spark, tmp_path):
    rng = random.Random(5)
    rows = [
        (f"p{rng.randrange(4)}", dt.date(2020, 1, 1) + rng.randrange(90) * DAY, float(rng.randrange(1, 9)), 2.0, str(k)) for k in range(300)
    ]
    rows += rows[:5]
    store = WeeklyDemand(spark, str(tmp_path / "demand"))
    assert store.demand().count() == 0 and store.batches() == set()
    parts = [[r for k, r in enumerate(rows) if k % 3 == b] for b in range(3)]
    taken = [store.take(spark.createDataFrame(parts[b], LINES), b) for b in (2, 0, 2, 1, 0)]
    assert taken == [True, True, False, True, False] and store.batches() == {0, 1, 2}
    whole = weekly_demand(spark.createDataFrame(rows, LINES).withColumn("week", F.trunc("date", "week")))
    assert sorted(map(tuple, store.demand().collect())) == sorted(map(tuple, whole.collect()))


def test_a_batch_cut_short_is_sent_again(spark, tmp_path, monkeypatch):
    rows = [("p", dt.date(2020, 1, 1) + k * DAY, 1.0, 1.0, str(k)) for k in range(20)]
    store = WeeklyDemand(spark, str(tmp_path / "demand"))
    real = WeeklyDemand._overwrite

    def cut(self, df, part, *by):
        if part == "demand":
            raise RuntimeError("lost")
        real(self, df, part, *by)

    monkeypatch.setattr(WeeklyDemand, "_overwrite", cut)
    with pytest.raises(RuntimeError):
        store.take(spark.createDataFrame(rows, LINES), 7)
    monkeypatch.setattr(WeeklyDemand, "_overwrite", real)
    assert store.batches() == set() and store.take(spark.createDataFrame(rows, LINES), 7)
    assert sum(r.quantity for r in store.demand().collect()) == 20


def test_a_small_batch_leaves_other_weeks_alone(spark, tmp_path):
    store = WeeklyDemand(spark, str(tmp_path / "demand"))
    store.take(spark.createDataFrame([("p", dt.date(2020, 1, 6) + k * 7 * DAY, 1.0, 1.0, str(k)) for k in range(6)], LINES), 1)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "demand" / "demand").rglob("*.parquet")}
    store.take(spark.createDataFrame([("p", dt.date(2020, 1, 15), 5.0, 1.0, "x")], LINES), 2)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "demand" / "demand").rglob("*.parquet")}
    changed = {p.parent.name for p in before.keys() ^ after.keys()}
    assert changed == {"week=2020-01-13"}


def test_zero_weeks(spark):
    rows = [("a", dt.date(2020, 1, 6), 2.0, 4.0, 1), ("a", dt.date(2020, 1, 27), 1.0, 1.0, 1), ("b", dt.date(2020, 1, 20), 3.0, 3.0, 2)]
    df = spark.createDataFrame(rows, "stock_code string, week date, quantity double, revenue double, line_count long")
    got = sorted((r.stock_code, r.week.day, r.quantity) for r in with_zero_weeks(df).collect())
    assert got == [("a", 6, 2.0), ("a", 13, 0.0), ("a", 20, 0.0), ("a", 27, 1.0), ("b", 20, 3.0), ("b", 27, 0.0)]
