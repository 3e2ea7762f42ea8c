"""Fitted tree ensembles as a relation: nodes read from a saved model, descended by joins, importances as an aggregate.

A saved ensemble is a table with one row per node. As a relation it can be queried, compared between fits and used
to score without the fitting library. Its size follows the number of trees and their depth, never the rows.
"""

from __future__ import annotations

import json

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

ROOT = 0
LEAF = -1


def stored_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(tree, weight, node, feature, threshold, low, high, gain, seen, share, value) of the ensemble saved at ``path``.

    ``low`` is where values up to the threshold go and is -1 in a leaf; ``seen`` is the weight of the rows that
    reached a node in the fit; ``share`` is that of the positive class among them (classification trees), ``value`` what the
    node predicts. Splits on categories are not read: assembled vectors have none.
    """
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "about", "weight").select("tree", "weight")
    stats = F.col("impurityStats")
    # regression trees keep (weight, sum, sum of squares), classification trees a weight per class
    by_class = F.size(stats) == 2
    total = F.when(by_class, stats[0] + stats[1]).otherwise(stats[0])
    return nodes.join(weights, "tree").select(
        "tree", "weight", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("low"), F.col("rightChild").alias("high"), "gain", total.alias("seen"),
        F.when(by_class & (total > 0), stats[1] / total).alias("share"), F.col("prediction").alias("value"),
    )


def stored_depth(spark: SparkSession, path: str) -> int:
    """The greatest depth that the ensemble saved at ``path`` was allowed."""
    about = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return int(about["paramMap"].get("maxDepth", about["defaultParamMap"]["maxDepth"]))


def leaves(rows: DataFrame, nodes: DataFrame, key: str, depth: int, features: str = "raw_features") -> DataFrame:
    """(key, tree, node): the leaf that each row reaches in each tree, one join with the nodes per level.

    Nodes hold no data row, so every join is with a table of the model's size, which Spark broadcasts while it is
    below the session's threshold; rows then never move.
    """
    inner = nodes.filter(F.col("low") != LEAF).select("tree", "node", "feature", "threshold", "low", "high")
    trees = nodes.agg(F.array_sort(F.collect_set("tree"))).scalar()
    state = rows.select(key, vector_to_array(features).alias("_x")).withColumn("tree", F.explode(trees))
    state = state.withColumn("node", F.lit(ROOT))
    for _ in range(depth):
        met = state.join(inner, ["tree", "node"], "left")
        side = F.when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("low")).otherwise(F.col("high"))
        state = met.select(key, "_x", "tree", F.when(F.col("low").isNull(), F.col("node")).otherwise(side).alias("node"))
    return state.drop("_x")


def ensemble_scores(
    rows: DataFrame, nodes: DataFrame, key: str, depth: int, boosted: bool, features: str = "raw_features"
) -> DataFrame:
    """(key, score) by descent: the mean share of the positive class over trees, or for ``boosted`` trees the logistic of
    twice their weighted sum. A row's trees meet in the task that holds the row, before any shuffle."""
    reached = leaves(rows, nodes, key, depth, features).join(nodes.select("tree", "node", "weight", "share", "value"), ["tree", "node"])
    if boosted:
        margin = F.sum(F.col("weight") * F.col("value"))
        return reached.groupBy(key).agg((1 / (1 + F.exp(-2 * margin))).alias("score"))
    return reached.groupBy(key).agg(F.avg("share").alias("score"))


def node_importances(nodes: DataFrame, boosted: bool) -> DataFrame:
    """(idx, importance) of the features that any split uses: gain times rows seen, summed and scaled to 1; each tree of a
    forest is scaled to 1 first."""
    gains = nodes.filter(F.col("low") != LEAF).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("seen")).alias("gain"))
    if not boosted:
        per_tree = gains.groupBy("tree").agg(F.sum("gain").alias("tree_gain"))
        gains = gains.join(per_tree, "tree").withColumn("gain", F.try_divide("gain", "tree_gain"))
    summed = gains.groupBy("feature").agg(F.sum("gain").alias("gain"))
    total = summed.agg(F.sum("gain")).scalar()
    return summed.select(F.col("feature").alias("idx"), (F.col("gain") / total).alias("importance"))
