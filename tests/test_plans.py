"""Physical plans must have the shape that holds at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import explore, prefix, quantiles, sampling, tables
from tallyhawk.operators.curves import roc_points, threshold_counts
from tallyhawk.plans.catalog import ORACLES, QUERIES
from tallyhawk.plans.entities import entities, scored_entities
from tallyhawk.plans.queries_data import lineitem
from tallyhawk.sources.readers import read_table
from tallyhawk.sources import writers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


def executed_scans(text):
    """Scans of the final plan, which ends where the initial plan of the whole query begins."""
    return text.split("\n+- == Initial Plan ==")[0].count("ColumnarToRow")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_python_workers_and_no_cross_joins(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert not re.search(r"PythonUDF|ArrowEval|MapInPandas|BatchEvalPython", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


def test_running_counts_read_the_data_once_and_never_sort_it_in_one_task(spark, small):
    text = final_plan(threshold_counts(scored_entities(spark, small)))
    assert executed_scans(text) == 1
    assert "ReusedExchange" in text and "ReusedSubquery" in text
    # Only the points that the merging tasks have made of their sketches meet in one task.
    assert set(re.findall(r"Exchange SinglePartition.*\n.*\(keys=\[\], functions=\[(\w+)\(", text)) == {"partial_collect_list"}
    assert text.count("Exchange SinglePartition") == len(re.findall(r"Exchange SinglePartition.*\n.*partial_collect_list", text))
    # The lookup of the bucket is not evaluated below the aggregation.
    assert "isnotnull(aggregate" not in text


def test_curve_points_share_one_scan(spark, small):
    assert executed_scans(final_plan(roc_points(scored_entities(spark, small), every=50))) == 1


def test_box_statistics_shuffle_partial_sums_only(spark, small):
    text = plan(quantiles.box_statistics(lineitem(spark, small), ["l_quantity", "l_tax"], ["l_returnflag"]))
    # the quartiles are stored by then, and a row of lineitem meets them where it is read
    assert "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") == 1
    assert "Generate" not in text.split("Exchange hashpartitioning")[1]


def test_splitters_are_merged_in_two_levels(spark):
    df = spark.range(0, 20_000).select((F.col("id") * 7919 % 20_011).cast("double").alias("v"), F.lit(1).cast("long").alias("n"))
    for buckets in (8, 512, 8192):
        found = prefix.quantile_bucket(df.repartition(9), "v", ["n"], buckets).groupBy("_bucket").agg(
            F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        ).orderBy("_bucket").collect()
        assert all(a["high"] < b["low"] for a, b in zip(found, found[1:]))
        assert max(r["n"] for r in found) <= 4 * 20_000 / buckets + 4


def test_narrow_reads(spark, small):
    text = plan(lineitem(spark, small).filter(F.col("l_discount") > 0.05).agg(F.sum("l_quantity")))
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.05)]" in text
    assert "ReadSchema: struct<l_quantity:double,l_discount:double>" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan(entities(spark, small))


def test_split_and_sample_do_not_shuffle(spark, small):
    events = read_table(spark, small, "events")
    for df in (
        sampling.split_by_key(events, "event_id"),
        sampling.bernoulli_sample(events, "event_id", 0.1),
        sampling.hash_folds(events, "event_id", 3),
        sampling.fraction_ladder(events, "event_id"),
    ):
        assert "Exchange" not in plan(df)


def test_oversampling_scans_once_for_rows_and_once_for_counts(spark, small):
    text = final_plan(sampling.oversample_minority(read_table(spark, small, "labels").withColumnRenamed("toxic", "label")))
    assert executed_scans(text) == 2 and "Generate explode" in text


def test_top_k_is_not_a_full_sort(spark, small):
    events = read_table(spark, small, "events")
    assert "TakeOrderedAndProject" in plan(explore.top_rows(events, [F.desc("value"), "event_id"], 10))


def test_dimension_join_is_broadcast_only_if_small(spark, small):
    nation = read_table(spark, small, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customer = read_table(spark, small, "customer")
    assert "BroadcastHashJoin" in plan(tables.enrich(customer, nation, "c_nationkey"))
    joined = tables.enrich(customer, nation, "c_nationkey")
    assert "broadcast" not in joined._jdf.queryExecution().logical().toString().lower()


def test_class_filter_prunes_folders(spark, small, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(entities(spark, small), path, "label", 4, salt_key="entity_id")
    text = plan(spark.read.parquet(path).filter("label = 1"))
    assert re.search(r"PartitionFilters: \[isnotnull\(label#\d+\), \(label#\d+ = 1\)\]", text)
