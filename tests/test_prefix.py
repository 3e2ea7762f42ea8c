import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyhawk.functions.hashing import key_hash
from tallyhawk.operators.prefix import quantile_bucket, rank_by_hash, running_totals


def brute(data, descending):
    out = []
    for group in {g for g, _, _ in data}:
        mine = sorted((r for r in data if r[0] == group), key=lambda r: r[1], reverse=descending)
        total, run = sum(r[2] for r in mine), 0
        for g, x, n in mine:
            run += n
            out.append((g, x, n, run, total))
    return sorted(out, key=repr)


def running(spark, data, descending, buckets):
    df = spark.createDataFrame(data, "g string, x double, n long").repartition(3)
    bucketed = quantile_bucket(df, "x", ["n"], buckets)
    order = [F.desc("x") if descending else F.asc("x")]
    out = running_totals(bucketed, ["g"], order, ["n"], descending)
    return sorted((tuple(r) for r in out.select("g", "x", "n", "run_n", "tot_n").collect()), key=repr)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [2, 8, 64])
def test_running_totals_match_brute_force(spark, descending, buckets):
    rng = random.Random(buckets)
    values = rng.sample(range(-1000, 1000), 300)
    # One group holds most of the rows; one group's name is null.
    data = [(rng.choice(["a", "a", "a", "a", "b", None]), float(v), rng.randint(0, 5)) for v in values]
    assert running(spark, data, descending, buckets) == brute(data, descending)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.tuples(st.sampled_from("ab"), st.floats(-1e6, 1e6).map(lambda v: v + 0.0)), st.integers(0, 9), min_size=1, max_size=30
    )
)
def test_running_totals_property(spark, table):
    data = [(g, x, n) for (g, x), n in table.items()]
    assert running(spark, data, True, 8) == brute(data, True)


def test_all_rows_share_one_value(spark):
    data = [(g, 1.0, 7) for g in "abc"]
    assert running(spark, data, False, 16) == brute(data, False)


def test_rank_by_hash_is_dense_and_ignores_placement(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 20 == 0, 1).otherwise(0).alias("label"))

    def ranks(frame):
        ranked = rank_by_hash(frame, ["label"], key_hash("id"), "id")
        return {r["id"]: (r["label"], r["rank"], r["stratum_rows"]) for r in ranked.collect()}

    first = ranks(df)
    assert first == ranks(df.repartition(7).orderBy(F.desc("id")))
    for label, size in ((0, 1900), (1, 100)):
        mine = [r for r in first.values() if r[0] == label]
        assert sorted(r[1] for r in mine) == list(range(1, size + 1))
        assert {r[2] for r in mine} == {size}
