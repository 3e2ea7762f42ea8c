import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhawk.operators.quantiles import box_statistics, exact_quantiles

PROBS = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]


def frames(spark, n, seed):
    rng = np.random.default_rng(seed)
    hot = np.where(rng.random(n) < 0.4, 3.0, rng.normal(0, 100, n))
    pdf = pd.DataFrame({"cont": rng.normal(0, 1, n), "hot": hot, "few": rng.integers(0, 4, n).astype(float)})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 101, 60_000])
def test_linear_quantiles_match_numpy(spark, n):
    pdf, df = frames(spark, n, n)
    got = {(r["feature"], r["p"]): r["q"] for r in exact_quantiles(df, list(pdf), PROBS).collect()}
    for c in pdf:
        for p in PROBS:
            assert got[c, p] == pytest.approx(float(np.quantile(pdf[c], p)), rel=1e-12, abs=1e-12), (c, p)


def test_lower_quantile_is_a_data_value(spark):
    pdf, df = frames(spark, 60_000, 3)
    got = {r["feature"]: r["q"] for r in exact_quantiles(df, list(pdf), [0.5], method="lower").collect()}
    for c in pdf:
        assert got[c] == float(np.quantile(pdf[c], 0.5, method="inverted_cdf"))


def test_grouped_quantiles_with_null_group_and_missing_values(spark):
    rng = np.random.default_rng(5)
    values = [(["x", None][i % 2], float(v)) for i, v in enumerate(rng.normal(size=999))]
    data = values + [("x", None), ("x", float("nan")), ("y", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, ["v"], [0.1, 0.5], by=["g"]).collect()}
    assert {g for g, _ in got} == {"x", None}
    for g in ("x", None):
        mine = [v for h, v in values if h == g]
        for p in (0.1, 0.5):
            assert got[g, p] == pytest.approx(float(np.quantile(mine, p)))


def test_column_without_values_gives_no_row(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert [r["feature"] for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()] == ["a"]


def test_box_statistics(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 3000), "v": rng.standard_t(2, 3000)})
    got = {r["g"]: r for r in box_statistics(spark.createDataFrame(pdf), ["v"], ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        q1, q2, q3 = np.quantile(part["v"], [0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = part["v"][(part["v"] >= lo) & (part["v"] <= hi)]
        r = got[g]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, q2, q3))
        assert (r["whisker_low"], r["whisker_high"]) == (inside.min(), inside.max())
        assert r["outliers"] == len(part) - len(inside) and r["n"] == len(part)


def test_unknown_method_is_refused(spark):
    with pytest.raises(ValueError):
        exact_quantiles(spark.range(3).select(F.col("id").cast("double")), ["id"], [0.5], method="nearest")
