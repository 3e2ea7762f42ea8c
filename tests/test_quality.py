import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhawk.operators import explore, layout, metrics, quality, tables
from tallyhawk.operators.quality import Expectations


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame(
        [(1.0, "a", 0), (None, "b", 1), (float("nan"), None, 2), (3.0, "d", None)], "x double, s string, y int"
    )


def test_missing_audit(gaps):
    got = {r["column"]: (r["nulls"], r["nans"], r["status"]) for r in quality.missing_audit(gaps).collect()}
    assert got == {"x": (1, 1, "WARN"), "s": (1, 0, "WARN"), "y": (1, 0, "WARN")}
    clean = quality.missing_audit(gaps.filter("x = 1"))
    assert {r["status"] for r in clean.collect()} == {"OK"}


def test_summary_leaves_out_missing_values(gaps):
    x = quality.column_summary(gaps, ["x"]).first()
    assert (x["n"], x["nulls"], x["nans"], x["mean"], x["min"], x["max"]) == (2, 1, 1, 2.0, 1.0, 3.0)


def test_domain_check_counts_null_as_outside(gaps):
    assert tuple(quality.domain_check(gaps, "y", [0, 1]).first()) == (2, False)


def test_expectations(gaps):
    rules = Expectations(min_rows=5, required=["x", "z"], not_null=["s", "w"], label="y")
    got = {r["rule"]: r["passed"] for r in quality.check_expectations(gaps, rules).collect()}
    assert got == {
        "rows >= 5": False, "column x present": True, "column z present": False, "column w present": False,
        "s has no nulls": False, "y in {0, 1}": False,
    }


def test_histogram_of_constant_and_of_sparse_columns(spark):
    constant = spark.createDataFrame([(2.0,)] * 3 + [(None,), (float("nan"),)], "x double")
    bins = explore.histogram(constant, "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [0, 0, 3, 0] and bins[0]["lower"] == 1.5 and bins[3]["upper"] == 2.5
    sparse = spark.createDataFrame([(0.0,), (0.1,), (10.0,)], "x double")
    assert [r["n"] for r in explore.histogram(sparse, "x", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 1]


def test_imbalance_ratio_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "label int")
    assert tuple(quality.imbalance_ratio(df).first()) == (2, 0, 2.0)


def test_partition_rows_include_empty_ones_and_salting_fills_them(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("flag"))
    plain = layout.partition_rows(layout.hash_repartition(df, 8, "flag"))
    assert plain.count() == 8 and plain.filter("n > 0").count() <= 2
    salted = layout.partition_rows(layout.hash_repartition(df, 8, "flag", salt_key="id"))
    assert salted.filter("n > 0").count() == 8
    balance = layout.partition_balance(plain).first()
    assert balance["n_partitions"] == 8 and balance["mean_rows"] == 125.0
    assert balance["recommendation"].startswith("WARN") and balance["skew_ratio"] >= 4.0
    assert layout.partition_balance(salted).first()["recommendation"] == "OK"


def test_partition_outliers(spark):
    counts = spark.createDataFrame([(i, 10) for i in range(20)] + [(20, 100)], "partition int, n long")
    assert [r["partition"] for r in layout.partition_outliers(counts).collect()] == [20]


def test_capped_sample_is_spread(spark):
    df = spark.range(100_000)
    for rows in (0, 1, 100, 33_333, 99_999, 100_000, 200_000):
        out = layout.capped_sample(df, rows, 4, "id")
        assert out.count() == min(rows, 100_000) and out.rdd.getNumPartitions() == 4
    assert "SinglePartition" not in layout.capped_sample(df, 100, 4, "id")._jdf.queryExecution().executedPlan().toString()
    small, large = (set(layout.capped_sample(df, n, 4, "id").collect()) for n in (50, 500))
    assert small < large and small == set(layout.capped_sample(df.repartition(7), 50, 2, "id").collect())
    # copies of a key go together, within the cap
    assert layout.capped_sample(spark.createDataFrame([(1,)] * 5 + [(2,)] * 2, "id int"), 4, 1, "id").count() in (0, 2)
    assert layout.capped_sample(spark.range(0), 5, 3, "id").count() == 0


def test_tagged_counts_speak_of_the_stored_partitions(spark, tmp_path):
    layout.tagged(spark.range(900).repartition(5, F.col("id") % 3)).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    counts = {r["partition"]: r["n"] for r in layout.tagged_rows(stored, 5).collect()}
    by_file = stored.groupBy("_metadata.file_path").agg(F.count("*").alias("n"), F.count_distinct("partition").alias("tags")).collect()
    assert len(counts) == 5 and sum(counts.values()) == 900
    assert sorted(r["n"] for r in by_file) == sorted(n for n in counts.values() if n) and {r["tags"] for r in by_file} == {1}


def test_enrich_small_and_large_dimension(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("a", "A")], "k string, name string")
    expected = [("a", 1, "A"), ("b", 2, None), (None, 3, None)]
    assert rows(tables.enrich(facts, dim, "k")) == sorted(expected, key=repr)


def test_stacking_tables_with_unequal_columns(spark):
    a = spark.createDataFrame([(2, 1.0)], "partitions int, t double")
    b = spark.createDataFrame([(2, 100, 1.0)], "partitions int, rows long, t double")
    out = tables.stack_tagged({"strong": a, "weak": b}, "type")
    assert {(r["type"], r["rows"]) for r in out.collect()} == {("strong", None), ("weak", 100)}
    scaled = metrics.relative_to_first(tables.stack_tagged({"x": a.union(spark.createDataFrame([(4, 0.5)], a.schema))}, "type"), "type", "partitions", "t")
    assert [(r["ideal"], r["speedup"], r["efficiency"]) for r in scaled.orderBy("partitions").collect()] == [(1.0, 1.0, 1.0), (0.5, 2.0, 1.0)]


def test_best_row_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", None)], "model string, f1 double")
    assert tables.best_row(df, "f1", "model").first()["model"] == "a"


def test_metric_ranges(spark):
    df = spark.createDataFrame([(0.5, 1.2), (1.0, None)], "f1 double, auc double")
    got = {r["metric"]: (r["outside"], r["ok"]) for r in quality.metric_range_check(df, ["f1", "auc"]).collect()}
    assert got == {"f1": (0, True), "auc": (2, False)}


def test_dataset_card(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 1)], "x double, label int")
    card = quality.dataset_card(df, "d", "label", {"counts": ["x"], "none": []}, "Parquet", "label", ["read", "checked"]).first()
    assert card["total_rows"] == 3 and card["imbalance_ratio"] == 2.0 and card["num_features"] == 1
    assert card["class_distribution"]["1_anomaly"] == 1 and card["lineage"]["step2"] == "checked"
    assert card["feature_groups"]["none"] == []
