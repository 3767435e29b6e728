import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from larder.operators.moments import column_pairs
from larder.operators.quality import column_stats, strongest_matrix, top_correlated
from larder.operators.ranks import percent_rank, positions, quantiles, tile, values_at_ranks


def spoilt(rng, size, columns):
    """Numbers of very different sizes with gaps, ties, NaN and infinite values."""
    rows = []
    for _ in range(size):
        row = [rng.gauss(0, 1), rng.gauss(1e6, 3), float(rng.randrange(4)), 5.0, 1e-8 * rng.random()]
        row.append(row[0] * 2 + rng.gauss(0, 0.1))
        row = [rng.choice([None, math.nan, math.inf]) if rng.random() < 0.15 else x for x in row]
        rows.append(tuple(row[:columns]))
    return rows


def finite(x):
    return x is not None and math.isfinite(x)


def test_pairs_equal_numpy_on_the_rows_that_have_both(spark):
    rows = spoilt(random.Random(1), 400, 6)
    names = [f"c{k}" for k in range(5)] + ["odd name"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(5)
    got = {(r.x, r.y): r for r in column_pairs(df, names).collect()}
    assert len(got) == 36
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = np.array([(r[i], r[j]) for r in rows if finite(r[i]) and finite(r[j])])
            found = got[a, b]
            assert found.n == len(both)
            assert found.covariance == pytest.approx(np.cov(both.T)[0, 1], rel=1e-9, abs=1e-15)
            if a == "c3" or b == "c3":
                assert found.correlation is None
            else:
                assert found.correlation == pytest.approx(np.corrcoef(both.T)[0, 1], abs=1e-9)


def test_pairs_of_little(spark):
    one = spark.createDataFrame([(1.0, None)], "a double, b double")
    rows = {(r.x, r.y): (r.n, r.correlation) for r in column_pairs(one, ["a", "b"]).collect()}
    assert rows == {("a", "a"): (1, None), ("a", "b"): (0, None), ("b", "a"): (0, None), ("b", "b"): (0, None)}
    assert column_pairs(one.limit(0), ["a", "b"]).count() == 0


def test_strongest_columns(spark):
    rng = random.Random(2)
    rows = [(x := rng.gauss(0, 1), x + rng.gauss(0, 0.1), -x + rng.gauss(0, 1), rng.gauss(0, 1), 1.0) for _ in range(300)]
    df = spark.createDataFrame(rows, "t double, near double, far double, none double, still double")
    names = ["near", "far", "none", "still"]
    assert [r.feature for r in top_correlated(df, "t", names, 2).collect()] == ["near", "far"]
    chosen = strongest_matrix(df, "t", names, 2).collect()
    assert {(r.x, r.y) for r in chosen} == {(a, b) for a in ("t", "near", "far") for b in ("t", "near", "far")}


def test_stats_equal_numpy(spark):
    rows = spoilt(random.Random(3), 333, 6)
    names = [f"c{k}" for k in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = {r.feature: r for r in column_stats(df, names).collect()}
    for k, name in enumerate(names):
        values = np.array([r[k] for r in rows if finite(r[k])])
        quartiles = np.percentile(values, [25, 50, 75])
        assert [got[name].q25, got[name].median, got[name].q75] == pytest.approx(list(quartiles), rel=1e-12, abs=1e-300)
        assert got[name].n == len(values) and got[name].std == pytest.approx(values.std(ddof=1), rel=1e-6, abs=1e-15)
        assert (got[name].min, got[name].max) == (values.min(), values.max())
    empty = column_stats(df.limit(0), names)
    assert empty.count() == 0


values = st.lists(st.tuples(st.sampled_from("ab"), st.one_of(
    st.none(), st.floats(allow_nan=True, allow_infinity=True, width=64), st.sampled_from([0.0, -0.0, 1.0, 5e-324, 1.7e308, -1.7e308]))), max_size=40)


@settings(max_examples=12, deadline=None)
@given(values)
def test_values_at_ranks_equal_sorting(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = defaultdict(dict)
    for r in values_at_ranks(df, ["k"], "v", lambda n: F.sequence(F.lit(1).cast("long"), n)).collect():
        got[r.k][r["rank"]] = r.v
    expected = defaultdict(list)
    for k, v in rows:
        if finite(v):
            expected[k].append(v)
    assert set(got) == set(expected)
    for k, own in expected.items():
        assert [got[k][i + 1] for i in range(len(own))] == sorted(own)


def test_quantiles_of_a_hot_key(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.9 else f"k{rng.randrange(9)}", rng.choice([rng.lognormvariate(0, 3), 2.0])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r.k: (r.low, r.high) for r in quantiles(df, ["k"], "v", {"low": 0.1, "high": 0.97}).collect()}
    for k in {k for k, _ in rows}:
        own = [v for x, v in rows if x == k]
        assert got[k] == pytest.approx(tuple(np.quantile(own, [0.1, 0.97])), rel=1e-12)


def test_positions_of_a_hot_group(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "hot", "hot", "hot", "x"]), rng.randrange(50), k) for k in range(1500)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(7)
    got = {r.id: (r.before, r.total) for r in positions(df, ["g"], [F.col("v").desc(), F.col("id")]).collect()}
    for g in (None, "hot", "x"):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        for place, r in enumerate(own):
            assert got[r[2]] == (place, len(own))


@pytest.mark.parametrize("total", [0, 1, 3, 5, 7, 23])
def test_tiles_equal_sql(spark, total):
    df = spark.range(total).select("id", F.expr("ntile(5) over (order by id)").alias("sql"))
    got = df.withColumn("own", tile(F.col("id"), F.lit(total), 5)).collect()
    assert all(r.own == r.sql for r in got)


def test_percent_rank_equals_sql(spark):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.9 else rng.choice([None, "x", "y"]), rng.choice([None, 1.0, 2.0, rng.random()]), k) for k in range(1200)]
    rows += [("alone", 3.0, 5000)]
    df = spark.createDataFrame(rows, "g string, v double, id int").repartition(5)
    got = {r.id: r.percent_rank for r in percent_rank(df, ["g"], "v").collect()}
    sql = df.selectExpr("id", "percent_rank() over (partition by g order by v nulls last) as p").collect()
    assert got == pytest.approx({r.id: r.p for r in sql})
    assert percent_rank(df.limit(0), ["g"], "v").count() == 0
