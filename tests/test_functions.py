import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from genolith.functions import special as sp
from genolith.operators.genes import upper_gamma


def column(spark, values, function, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r["y"] for r in df.select(function(F.col("x")).alias("y")).collect()]


def test_erfc_and_tails(spark):
    xs = [-5.0, -1.0, -0.2, 0.0, 0.3, 0.46, 0.5, 2.0, 3.99, 4.01, 9.0, 25.0]
    for got, x in zip(column(spark, xs, sp.erfc), xs):
        assert got == pytest.approx(math.erfc(x), rel=1e-13)
    for got, x in zip(column(spark, xs, sp.normal_cdf), xs):
        assert got == pytest.approx(statistics.NormalDist().cdf(x), rel=1e-9, abs=1e-300)
    assert column(spark, [3.841458820694124], sp.chi2_1_sf)[0] == pytest.approx(0.05, rel=1e-10)


def test_normal_quantile_inverts(spark):
    ps = [1e-300, 1e-12, 0.001, 0.3, 0.5, 0.975, 1 - 1e-10]
    for got, p in zip(column(spark, ps, sp.normal_quantile), ps):
        assert got == pytest.approx(statistics.NormalDist().inv_cdf(p), abs=1e-12)
    assert column(spark, [0.0, 1.0, 2.0], sp.normal_quantile) == [-math.inf, math.inf, None]


def test_chi2_with_column_degrees(spark):
    df = spark.createDataFrame([(x, k) for x in (0.1, 2.0, 30.0) for k in range(1, 12)], "x double, k int")
    for r in df.select("x", "k", sp.chi2_sf(F.col("x"), F.col("k")).alias("p")).collect():
        assert r["p"] == pytest.approx(upper_gamma(np.array([r["k"] / 2]), np.array([r["x"] / 2]))[0], rel=1e-9)


def test_hypergeometric_against_exact_counts(spark):
    cases = [(x, u, m, d) for u, m, d in ((50, 10, 8), (30, 20, 25), (12, 3, 3)) for x in range(0, min(m, d) + 2)]
    df = spark.createDataFrame(cases, "x long, u long, m long, d long")
    for r in df.select("*", sp.hypergeometric_sf(*[F.col(c) for c in "xumd"]).alias("p")).collect():
        low, high = max(r["x"], r["m"] + r["d"] - r["u"], 0), min(r["m"], r["d"])
        want = sum(math.comb(r["m"], k) * math.comb(r["u"] - r["m"], r["d"] - k) for k in range(low, high + 1)) / math.comb(r["u"], r["d"])
        assert r["p"] == pytest.approx(want, rel=1e-9, abs=1e-15)


def test_log_gamma(spark):
    xs = [0.5, 1.0, 3.7, 12.0, 1e5]
    for got, x in zip(column(spark, xs, sp.log_gamma), xs):
        assert got == pytest.approx(math.lgamma(x), rel=1e-12, abs=1e-12)
