import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.config import ForecastRules
from larder.operators import evaluation, folds, forecast, models
from larder.operators.baselines import moving_average, seasonal_naive
from larder.plans.lookups import top_recommendations

DAY = dt.date(2011, 1, 3)
RULES = ForecastRules(features=("quantity_lag1", "day_of_week", "is_weekend"), horizon=9,
                      checkpoint_every=4, models=("RandomForest",), min_train_days=30)


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(4)
    rows = []
    for code in ("a", "b", "c"):
        previous = 0.0
        for i in range(100):
            date = DAY + dt.timedelta(days=i)
            quantity = float(10 * (date.weekday() >= 5) + rng.integers(0, 3))
            rows.append((code, date, quantity, previous, date.weekday(), int(date.weekday() >= 5)))
            previous = quantity
    return spark.createDataFrame(
        rows, "stock_code string, date date, quantity double, quantity_lag1 double, "
              "day_of_week int, is_weekend int").persist()


def test_metrics_sample(spark):
    rows = list(zip([100.0, 200.0, 150.0, 300.0, 0.0], [90.0, 210.0, 160.0, 280.0, 5.0]))
    df = spark.createDataFrame(rows, "actual double, predicted double").withColumn("model", F.lit("m"))
    row = evaluation.forecast_metrics(df, ["model"]).first()
    assert (row["WAPE"], row["MAPE"], row["MAE"], row["RMSE"], row["Bias"], row["MdAPE"]) == (
        7.3333, 7.0833, 11.0, 12.0416, -1.0, 6.6667)


def test_metrics_without_sales(spark):
    df = spark.createDataFrame([("m", 0.0, 2.0)], "model string, actual double, predicted double")
    row = evaluation.forecast_metrics(df, ["model"]).first()
    assert (row["WAPE"], row["MAPE"], row["MdAPE"], row["MAE"]) == (0.0, 0.0, 0.0, 2.0)


def test_folds_do_not_leak(history):
    rows = folds.cv_folds(history, folds=3, horizon=20, min_train_days=50).orderBy("fold").collect()
    assert [r["fold"] for r in rows] == [1, 2]
    assert rows[-1]["test_end"] == DAY + dt.timedelta(days=99)
    for r in rows:
        assert r["train_end"] + dt.timedelta(days=1) == r["test_start"]
        assert (r["test_end"] - r["test_start"]).days == 19
    assert rows[0]["test_end"] == rows[1]["train_end"]


def test_one_fold_fits_120_days(spark):
    days = spark.range(121).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"))
    assert folds.cv_folds(days, folds=3, horizon=28, min_train_days=90).count() == 1


def test_history_cuts(history):
    assert folds.recent_history(history, 10).select("date").distinct().count() == 11
    assert folds.with_min_history(history, 101).count() == 0


def test_baselines_fall_back(spark):
    train = spark.createDataFrame(
        [("a", DAY, 4.0, 0), ("a", DAY + dt.timedelta(days=7), 6.0, 0), ("a", DAY + dt.timedelta(days=8), 2.0, 1)],
        "stock_code string, date date, quantity double, day_of_week int")
    test = spark.createDataFrame([("a", 0), ("a", 5), ("new", 0)], "stock_code string, day_of_week int")
    got = {(r["stock_code"], r["day_of_week"]): r["predicted"] for r in seasonal_naive(train, test).collect()}
    assert got == {("a", 0): 5.0, ("a", 5): 4.0, ("new", 0): 0.0}
    got = {(r["stock_code"], r["day_of_week"]): r["predicted"] for r in moving_average(train, test, 2).collect()}
    assert got == {("a", 0): 4.0, ("a", 5): 4.0, ("new", 0): 0.0}


def test_models_beat_guessing_and_rank(history):
    per_fold = models.cross_validate(history, RULES)
    assert {r["model"] for r in per_fold.collect()} == {"RandomForest", "SeasonalNaive"}
    ranking = evaluation.rank_models(per_fold).orderBy("rank").collect()
    assert [r["rank"] for r in ranking] == [1, 2] and ranking[0]["WAPE"] <= ranking[1]["WAPE"]
    assert ranking[0]["WAPE"] < 60


def test_metrics_equal_sql_over_stored_predictions(history, tmp_path):
    """Every model's metrics of a fold, computed again by another engine from its written predictions."""
    import duckdb

    rules = ForecastRules(features=RULES.features, horizon=9, folds=2, min_train_days=30, models=("RandomForest", "GradientBoosting"))
    names = models.feature_names(rules)
    table = models._assembler(names).transform(models.model_input(history, names))
    fold_rows = folds.cv_folds(table, rules.folds, rules.horizon, rules.min_train_days).collect()
    for fold in fold_rows:
        predictions = models.fold_predictions(table, fold, rules)
        path = str(tmp_path / f"fold{fold['fold']}")
        predictions.write.parquet(path)
        ours = evaluation.forecast_metrics(predictions.sparkSession.read.parquet(path), ["model", "fold"]).collect()
        sql = duckdb.sql(f"""
            SELECT model, fold, sum(abs(predicted - actual)) / sum(abs(actual)) * 100 AS WAPE,
                   avg(abs((predicted - actual) / actual)) FILTER (actual > 1e-8) * 100 AS MAPE, avg(abs(predicted - actual)) AS MAE,
                   sqrt(avg((predicted - actual) ** 2)) AS RMSE, avg(predicted - actual) AS Bias,
                   median(abs((predicted - actual) / actual)) FILTER (actual > 1e-8) * 100 AS MdAPE
            FROM '{path}/*.parquet' GROUP BY model, fold""")
        theirs = {(r[0], r[1]): r[2:] for r in sql.fetchall()}
        assert {(r.model, r.fold) for r in ours} == set(theirs) and len(theirs) == 3
        for r in ours:
            assert (r.WAPE, r.MAPE, r.MAE, r.RMSE, r.Bias, r.MdAPE) == pytest.approx(theirs[r.model, r.fold], abs=1e-4)
    assert len(fold_rows) == 2


def test_a_fit_that_fails_fails_the_comparison(history, monkeypatch):
    class Broken:
        def fit(self, train):
            raise RuntimeError("lost")

    monkeypatch.setattr(models, "estimator", lambda name, seed: Broken())
    with pytest.raises(RuntimeError, match="lost"):
        models.cross_validate(history, RULES)


def test_model_round_trip_forecast_and_request(spark, history, tmp_path):
    fitted = models.fit_model(history, "RandomForest", RULES)
    models.save_model(spark, fitted, "RandomForest", str(tmp_path))
    name, model = models.load_best_model(spark, str(tmp_path))
    assert name == "RandomForest"
    importance = models.feature_importance(spark, model).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)

    made = forecast.forecast_next_days(history, model, RULES).toPandas().sort_values(["stock_code", "date"])
    assert len(made) == 3 * RULES.horizon and (made.forecast_quantity >= 0).all()
    assert made.date.min() == DAY + dt.timedelta(days=100)

    # Step by step, one prediction at a time, gives the same path.
    lag = history.where("stock_code = 'a'").orderBy(F.desc("date")).first()["quantity_lag1"]
    for row in made[made.stock_code == "a"].itertuples():
        weekday = row.date.weekday()
        one = spark.createDataFrame([("a", row.date, float(lag), weekday, int(weekday >= 5))],
                                    "stock_code string, date date, quantity_lag1 double, day_of_week int, "
                                    "is_weekend int")
        lag = models.predict(one, model).first()["predicted_quantity"]
        assert row.forecast_quantity == pytest.approx(lag)

    first, last = dt.date(2012, 1, 1), dt.date(2012, 1, 10)
    got = forecast.predict_range(history, model, ["a", "zz", "a"], first, last).collect()
    assert {r["stock_code"] for r in got} == {"a"} and len(got) == 10
    got = forecast.predict_range(history, model, ["yy", "zz"], first, last).collect()
    assert len(got) == 20
    got = forecast.predict_range(history, None, ["a"], first, last).collect()
    assert len(got) == 10


def test_request_checks():
    day = dt.date(2012, 1, 1)
    with pytest.raises(ValueError):
        forecast.check_request(["a"], day, day - dt.timedelta(days=1))
    with pytest.raises(ValueError):
        forecast.check_request(["a"], day, day + dt.timedelta(days=366), most_days=365)
    with pytest.raises(ValueError):
        forecast.check_request([str(i) for i in range(501)], day, day, most_products=500)
    many = [str(i) for i in range(5000)]
    assert forecast.check_request(many, day, day + dt.timedelta(days=5000)) == many
    assert forecast.check_request(["b", "a", "b"], day, day) == ["b", "a"]
    with pytest.raises(ValueError):
        top_recommendations(None, 0)


def test_trend_model(spark, history):
    got = forecast.trend_seasonal(history, horizon=14).toPandas()
    assert len(got) == 3 * 14 and (got.wape < 0.8).all()
    short = history.where(F.col("date") < F.lit(DAY + dt.timedelta(days=20)))
    assert np.isinf(forecast.trend_seasonal(short, 14).toPandas().wape).all()


def test_backtest(spark, history):
    made = history.select("stock_code", "date", (F.col("quantity") + 1).alias("forecast_quantity"))
    rows = evaluation.backtest_rows(history, made, 30)
    summary = evaluation.backtest_summary(rows).first()
    assert (summary["n"], summary["bias"], summary["mae"]) == (90, 1.0, 1.0)


def plain_trend(days, actual, horizon):
    """Least squares by NumPy on the same terms and ridge."""
    terms = [np.ones_like(days), days / 365.0]
    for period, pairs in ((7.0, 3), (365.25, 5)):
        for k in range(1, pairs + 1):
            terms += [np.sin(2 * np.pi * k * days / period), np.cos(2 * np.pi * k * days / period)]
    x, split = np.column_stack(terms), max(10, len(days) - horizon)
    past = x[:split]
    weights = np.linalg.solve(past.T @ past + 1e-3 * np.eye(x.shape[1]), past.T @ actual[:split])
    predicted = np.clip(x[split:] @ weights, 0, None)
    size = np.abs(actual[split:]).sum()
    return predicted, np.abs(actual[split:] - predicted).sum() / size if size else 0.0


def test_trend_equals_numpy_and_runs_no_python(spark):
    rng = np.random.default_rng(7)
    start, rows, expected = dt.date(2020, 1, 1), [], {}
    for code, length in (("long", 900), ("year", 365), ("month", 40), ("gaps", 200), ("none", 60), ("short", 29), ("one", 1)):
        at = np.arange(length) if code != "gaps" else np.sort(rng.choice(600, length, replace=False))
        value = np.zeros(length) if code == "none" else rng.poisson(5 + 4 * np.sin(at / 58) + 2 * (at % 7 == 3)) - 2.0
        days = [start + dt.timedelta(days=int(d)) for d in at]
        rows += [(code, d, float(v)) for d, v in zip(days, value)]
        if length >= 30:
            predicted, wape = plain_trend((at - at[0]).astype(float), np.clip(value, 0, None), 14)
            expected |= {(code, d): (p, wape) for d, p in zip(days[-len(predicted):], predicted)}
    sales = spark.createDataFrame(rows, "stock_code string, date date, quantity double").repartition(5)
    found = forecast.trend_seasonal(sales, horizon=14)
    got = {(r.stock_code, r.date): (r.predicted, r.wape) for r in found.collect()}
    lone = {k for k in got if k[0] in ("short", "one")}
    assert len(lone) == 2 and all(got[k] == (0.0, float("inf")) for k in lone)
    assert set(got) - lone == set(expected)
    for key, (predicted, wape) in expected.items():
        assert got[key] == pytest.approx((predicted, wape), abs=1e-6)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "Arrow" not in plan
    assert forecast.trend_seasonal(sales.limit(0)).count() == 0
