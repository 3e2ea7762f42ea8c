import math

import pytest
from pyspark.sql import functions as F

from tallyhawk.functions.scalars import guarded_ratio
from tallyhawk.operators import features, preprocessing, quality
from tallyhawk.operators.features import EVENT_CODES, EVENT_GROUPS, STATISTICS, wide_event_plan
from tallyhawk.sources.dimensions import event_dimension


@pytest.fixture(scope="module")
def unit(spark):
    """All events one, all events zero."""
    names = ", ".join(f"{c} double" for c in EVENT_CODES)
    data = [(*[1.0] * 29, 0, 29.0), (*[0.0] * 29, 1, 0.0)]
    return spark.createDataFrame(data, f"{names}, Label int, total_events double")


def test_group_sums_of_unit_rows(unit):
    out = preprocessing.ColumnGroupSum(groups=EVENT_GROUPS).transform(unit)
    ones = out.filter("Label = 0").first()
    assert [ones[g] for g in EVENT_GROUPS] == [8.0, 5.0, 4.0, 6.0]
    zeros = out.filter("Label = 1").first()
    assert [zeros[g] for g in EVENT_GROUPS] == [0.0] * 4


def test_a_null_member_makes_the_sum_null(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    assert [r["s"] for r in features.group_sums(df, {"s": ["a", "b"]}).collect()] == [None, 3.0]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, -1.0), (1.0, None), (None, 2.0)], "n double, d double")
    assert [r[0] for r in df.select(guarded_ratio("n", "d")).collect()] == [0.5, 0.0, 0.0, 0.0, None]


def test_row_statistics(spark):
    df = spark.createDataFrame([(1.0, 2.0, 6.0), (0.0, 0.0, 0.0), (4.0, 4.0, 4.0)], "a double, b double, c double")
    got = [tuple(r) for r in features.row_statistics(df, ["a", "b", "c"]).select(*STATISTICS).collect()]
    assert got[0] == pytest.approx((9.0, 3.0, math.sqrt(7.0), 6.0, 1.0, 3.0, 0.0, 6 / 9, 1 / 6))
    assert got[1] == pytest.approx((0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0))
    assert got[2] == pytest.approx((12.0, 4.0, 0.0, 4.0, 4.0, 3.0, 0.0, 1 / 3, 1.0))


def test_flags_are_strict(spark):
    df = spark.createDataFrame([(0.0, 0.7), (0.1, 0.71)], "e double, s double")
    out = features.flag_features(df, {"has": ("e", 0.0), "high": ("s", 0.7)}).select("has", "high")
    assert [tuple(r) for r in out.collect()] == [(0.0, 0.0), (1.0, 1.0)]


def test_zero_fill_of_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (2.0,)], "x double")
    assert [r["x"] for r in features.zero_fill(df, ["x"]).collect()] == [0.0, 0.0, 2.0]


def test_pairs_and_powers(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    r = features.power_features(features.pair_features(df, ["a", "b"]), ["b"]).first()
    assert (r["a_b_interaction"], r["a_b_ratio"], r["b_squared"], r["b_cubed"]) == (6.0, 0.5, 9.0, 27.0)
    assert r["b_log"] == pytest.approx(math.log(4))


def test_wide_plan_has_56_distinct_features(spark):
    plan = wide_event_plan()
    assert len(plan.names) == len(set(plan.names)) == 56
    assert len(plan.imputed) == 38


def test_unmapped_event_codes_are_reported(spark):
    out = quality.coverage_check(spark, event_dimension(spark), "event_code", EVENT_GROUPS)
    unmapped = {r["event_code"] for r in out.filter(~F.col("mapped")).collect()}
    assert unmapped == {"E1", "E10", "E12", "E13", "E17", "E20"}


def test_median_imputer_fills_null_and_nan_and_reloads(spark, tmp_path):
    data = [(1.0, 5), (2.0, None), (float("nan"), 7), (None, 9), (10.0, 11)]
    df = spark.createDataFrame(data, "x double, y int")
    fitted = preprocessing.MedianImputer(columns=["x", "y"]).fit(df)
    expected = [(1.0, 5.0), (2.0, 7.0), (2.0, 7.0), (2.0, 9.0), (10.0, 11.0)]
    assert sorted(map(tuple, fitted.transform(df).collect())) == sorted(expected)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    again = preprocessing.MedianImputerModel.load(str(tmp_path / "m"))
    assert sorted(map(tuple, again.transform(df).collect())) == sorted(expected)
    with pytest.raises(ValueError):
        preprocessing.MedianImputer(columns=["z"]).fit(spark.createDataFrame([(None,)], "z double"))


def test_custom_stages_keep_their_parameters_when_saved(spark, tmp_path):
    stage = preprocessing.ColumnGroupSum(groups={"s": ["a", "b"]})
    stage.write().overwrite().save(str(tmp_path / "s"))
    again = preprocessing.ColumnGroupSum.load(str(tmp_path / "s"))
    assert again.getOrDefault(again.groups) == {"s": ["a", "b"]}


def test_scaling_of_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "x double, k double")
    std = preprocessing.standard_scores(df, ["x", "k"]).orderBy("x").collect()
    assert [r["k_std"] for r in std] == [0.0, 0.0]
    assert [r["x_std"] for r in std] == pytest.approx([-math.sqrt(0.5), math.sqrt(0.5)])
    mm = preprocessing.min_max_scores(df, ["x", "k"]).orderBy("x").collect()
    assert [(r["x_mm"], r["k_mm"]) for r in mm] == [(0.0, 0.5), (1.0, 0.5)]
