"""Labelled entity table over the ``events`` table, its feature plan and two fixed linear scorers.

An entity is one user on one day. It is labelled anomalous if any of its values reaches 200.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhawk.operators.features import FeaturePlan
from tallyhawk.operators.sampling import class_weights, split_by_key
from tallyhawk.sources.readers import read_table

KINDS = ["click", "error", "purchase", "signup", "view"]
COUNTS = [f"n_{kind}" for kind in KINDS]
GROUPS = {
    "cat_engage": ["n_click", "n_view"],
    "cat_convert": ["n_purchase", "n_signup"],
    "cat_error": ["n_error"],
}
PLAN = FeaturePlan(
    counts=COUNTS,
    groups=GROUPS,
    ratios={"error_ratio": ("cat_error", "total_events")},
    logs=["total_events", "cat_engage", "cat_error"],
    flags={"has_error": ("cat_error", 0.0), "high_sparsity": ("event_sparsity", 0.7)},
    pairs=["n_click", "n_error", "n_view"],
    powers=["n_click", "n_error"],
    extra=["sum_value"],
)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    day = F.to_date("ts")
    grouped = events.groupBy("user_id", day.alias("day")).agg(
        *[F.count_if(F.col("event_type") == kind).alias(f"n_{kind}") for kind in KINDS],
        F.count(F.lit(1)).alias("total_events"),
        F.round(F.sum("value"), 2).alias("sum_value"),
        F.max((F.col("value") >= 200).cast("int")).alias("label"),
    )
    entity_id = F.col("user_id") * 100_000 + F.unix_date("day")
    return grouped.select(entity_id.alias("entity_id"), *grouped.columns)


def scored_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, entity_id, label, score, prediction) of both fixed scorers, from one pass."""
    base = entities(spark, sf_dir)
    a = F.round(0.01 * F.col("sum_value") + 0.1 * F.col("n_error") - 2.75, 6)
    b = F.round(0.01 * F.col("sum_value") - 0.25 * F.col("total_events") - 1.5, 6)
    scorers = [F.struct(F.lit(name).alias("model"), value.alias("score")) for name, value in (("a", a), ("b", b))]
    long = base.select("entity_id", "label", F.explode(F.array(*scorers)).alias("_s"))
    return long.select("_s.model", "entity_id", "label", "_s.score", (F.col("_s.score") > 0).cast("int").alias("prediction"))


def labelled_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with their split; the label-defining maximum is not among the columns."""
    return split_by_key(entities(spark, sf_dir), "entity_id")


def split_frame(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)


def weighted_train(df: DataFrame) -> DataFrame:
    return class_weights(split_frame(df, "train"))
