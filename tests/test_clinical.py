import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from genolith.operators import clinical as cl, ranking, trends


def series_frame(spark, series):
    rows = [(k, i, None if v is None else float(v)) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "k string, i int, x double")


CASES = {
    "flat": [3, 3, 3], "down": [3, None, 2, 2], "up": [0, 0, 1], "short": [2, 1], "gap": [5, None, None, 5, 4], "none": [None, None],
    "zero": [0, 0, 0, 0], "updown": [1, 4, 2, 6],
}


def test_changes_by_hand(spark):
    out = {r["k"]: (r["s_ever_decreased"], r["s_ever_increased"]) for r in trends.ever_changed(series_frame(spark, CASES), ["k"], ["i"], "x", "s").collect()}
    assert out["flat"] == (False, False) and out["down"] == (True, False) and out["up"] == (False, True)
    assert out["short"] == (None, None) and out["gap"] == (True, False) and "none" not in out
    assert out["updown"] == (True, True)


def test_missing_code_counts_as_a_value(spark):
    df = series_frame(spark, {"a": [None, 0, None]})
    row = trends.ever_changed(df, ["k"], ["i"], "x", "s", missing=-1).first()
    # -1 -> 0 is a change of -100 percent, 0 -> -1 an unbounded fall.
    assert row["s_ever_decreased"] is True


def reference_total(xs):
    total, last = 0.0, None
    for x in xs:
        if last is not None and x < last:
            total += last
        last = x
    return total + (last or 0.0)


def legacy_total(xs):
    xs, value = list(xs), 0.0
    while True:
        running = np.maximum.accumulate(xs)
        below = np.nonzero(np.array(xs) < running)[0]
        if not len(below):
            return value
        value += running[below[0]]
        xs = xs[below[0]:]
        value += max(xs)


def test_counters_on_a_hot_subject(spark):
    rng = np.random.default_rng(0)
    data = {"hot": rng.integers(0, 30, 4000).tolist(), **{f"s{i}": rng.integers(0, 30, 12).tolist() for i in range(30)}}
    df = series_frame(spark, data).repartition(8)
    new = {r["k"]: r["h"] for r in trends.resettable_total(df, ["k"], ["i"], "x", "h").collect()}
    old = {r["k"]: r["h"] for r in trends.resettable_total_legacy(df, ["k"], ["i"], "x", "h").collect()}
    for k, xs in data.items():
        assert new[k] == reference_total(xs)
        assert old[k] == legacy_total(xs)


def test_hispanic_is_three_valued(spark):
    df = spark.createDataFrame([("Hispanic or Latino",), ("Unknown / Not Reported",), (None,), ("Other",)], "e string")
    assert [r[0] for r in df.select(cl.is_hispanic(F.col("e"))).collect()] == [True, None, None, False]


def test_contrasts_prefer_death(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, true, true, true, 5D, false, true), (2, false, true, true, 5D, true, false), (3, NULL, NULL, NULL, NULL, NULL, NULL)
      AS t(Subject_ID, deceased, recovered, discharged, max_who, severity_ever_increased, severity_ever_decreased)""")
    out = {r["Subject_ID"]: r for r in cl.contrast_phenotypes(df).collect()}
    assert (out[1]["deceased_vs_recovered"], out[1]["max_who"], out[1]["discharged"]) == (True, 8.0, False)
    assert (out[2]["deceased_vs_recovered"], out[2]["recovered_not_deceased"]) == (False, True)
    assert out[3]["deceased_vs_discharged"] is None


def test_percentile_and_irnt_match_pandas(spark):
    rng = np.random.default_rng(5)
    values = np.where(rng.uniform(size=900) < 0.34, 7.0, rng.integers(0, 200, 900).astype(float))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, x double").repartition(6)
    got = ranking.irnt(ranking.percentile_rank(df, "x"), "x").orderBy("i").toPandas()
    assert np.allclose(got["x_percentile"], pd.Series(values).rank(pct=True))
    assert np.isinf(got["x_irnt"]).sum() == (values == values.max()).sum() if (values == values.max()).sum() == 1 else True
    assert np.isfinite(ranking.irnt(df, "x", offset=True).toPandas()["x_irnt"]).all()


def test_transformed_columns(spark):
    df = spark.createDataFrame([(i, float(i % 5), None if i % 3 else float(i)) for i in range(30)], "Subject_ID int, a double, b double")
    out = cl.transformed(df, ["a", "b"]).orderBy("Subject_ID").toPandas()
    for c in "ab":
        assert np.allclose(out[f"{c}_percentile"], out[c].rank(pct=True), equal_nan=True)
        assert np.allclose(out[f"{c}_log"], np.log1p(out[c]), equal_nan=True)


def test_quantile_and_adjustment_match_numpy(spark):
    rng = np.random.default_rng(6)
    p = np.round(rng.uniform(size=500) ** 2, 2) + 1e-3
    df = spark.createDataFrame([(i, "g" if i % 3 else "h", float(v)) for i, v in enumerate(p)], "i int, g string, p double")
    got = ranking.adjust_p(df, "p", ["g"]).toPandas()
    for name, part in got.groupby("g"):
        order = part.sort_values("p")
        n = len(order)
        raw = np.minimum(1, order["p"].to_numpy() * n / np.arange(1, n + 1))
        assert np.allclose(order["fdr"], np.minimum.accumulate(raw[::-1])[::-1])
        assert np.allclose(order["bonferroni"], np.minimum(1, order["p"] * n))
    med = {r["g"]: r["quantile"] for r in ranking.exact_quantile(df, "p", 0.3, ["g"]).collect()}
    for name, part in got.groupby("g"):
        assert med[name] == pytest.approx(np.quantile(part["p"], 0.3))


def test_one_hot_and_multi_batch(spark):
    df = spark.createDataFrame([(1, "A+B"), (2, "B"), (3, None)], "k int, f string")
    out = {r["k"]: (r["f_A"], r["f_B"]) for r in cl.one_hot(df, "k", "f", "f_", "+").collect()}
    assert out == {1: (1, 1), 2: (0, 1)}


def test_many_small_groups_are_spread_by_their_rows(spark, monkeypatch):
    from functools import partial

    from genolith import session

    monkeypatch.setattr(ranking, "in_more_tasks", partial(session.in_more_tasks, each=150))
    df = spark.range(3000).selectExpr("concat('group', id % 1000) AS g", "id * 7 % 3000 AS x")
    counts = ranking.cumulative_counts(df, "x", ["g"])
    tasks = counts.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    # Two or three values a group; before, the rows went to as many tasks as there are cores at most.
    assert sum(r["n"] for r in tasks) == 3000 and max(r["n"] for r in tasks) <= 450
    got = {r["g"]: r["m"] for r in ranking.exact_quantile(df, "x", 0.5, ["g"], "m").collect()}
    assert got == {f"group{i}": sorted((i + 1000 * k) * 7 % 3000 for k in range(3))[1] for i in range(1000)}
