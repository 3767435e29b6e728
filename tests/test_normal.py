from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from larder.functions.normal import normal_cdf, normal_quantile


def test_quantile_and_cdf_equal_the_library(spark):
    chances = [1e-12, 1e-6, 0.0013, 0.02, 0.1, 0.25, 0.4999, 0.5, 0.5001, 0.75, 0.9, 0.975, 0.999, 1 - 1e-9]
    rows = spark.createDataFrame([(p,) for p in chances], "p double").select("p", normal_quantile(F.col("p")).alias("z")).collect()
    for p, z in rows:
        assert z == pytest.approx(NormalDist().inv_cdf(p), abs=1e-9)
    points = [-8.0, -3.6, -3.4, -1.0, 0.0, 0.3, 2.0, 3.49, 3.51, 6.0]
    rows = spark.createDataFrame([(x,) for x in points], "x double").select("x", normal_cdf(F.col("x")).alias("p")).collect()
    for x, p in rows:
        assert p == pytest.approx(NormalDist().cdf(x), abs=1e-12)


def test_what_is_no_chance_has_no_quantile(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (-0.5,), (2.0,), (None,), (float("nan"),)], "p double")
    assert [r.z for r in rows.select(normal_quantile(F.col("p")).alias("z")).collect()] == [None] * 6
