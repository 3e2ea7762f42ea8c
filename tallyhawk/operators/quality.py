"""Data-quality profiling: counts, missing values, domains, summaries, expectations, cards."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhawk.functions.rows import melt
from tallyhawk.functions.scalars import is_missing, percent, present


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def _is_nan(df: DataFrame, name: str):
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return F.isnan(name) if floating else F.lit(False)


def missing_audit(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, nulls, nans, status) for all columns in one pass; status is OK or WARN."""
    cols = cols or df.columns
    counts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(cols)],
        *[F.count_if(_is_nan(df, c)).alias(f"nan_{i}") for i, c in enumerate(cols)],
    )
    long = melt(
        counts,
        [
            {"column": F.lit(c), "nulls": F.col(f"null_{i}"), "nans": F.col(f"nan_{i}")}
            for i, c in enumerate(cols)
        ],
    )
    clean = (F.col("nulls") == 0) & (F.col("nans") == 0)
    return long.withColumn("status", F.when(clean, "OK").otherwise("WARN"))


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Class counts with their share of all rows in percent, ordered by class."""
    counts = class_counts(df, label)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", percent(F.col("n"), total)).orderBy(label)


def class_pair(df: DataFrame, label: str = "label") -> DataFrame:
    """One row (n0, n1): rows of class 0 and of class 1."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("n0"),
        F.count_if(F.col(label) == 1).alias("n1"),
    )


def imbalance_ratio(df: DataFrame, label: str = "label") -> DataFrame:
    """(n0, n1, ratio) with the divisor floored at one."""
    return class_pair(df, label).withColumn("ratio", F.col("n0") / F.greatest(F.col("n1"), F.lit(1)))


def column_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n, nulls, nans, mean, stddev, min, max), typed; nulls and NaNs do not enter the moments."""
    aggregates = []
    for i, c in enumerate(cols):
        value = F.col(c).cast("double")
        value = present(value)
        aggregates += [
            F.count(value).alias(f"n_{i}"),
            F.count_if(F.col(c).isNull()).alias(f"null_{i}"),
            F.count_if(_is_nan(df, c)).alias(f"nan_{i}"),
            F.avg(value).alias(f"mean_{i}"),
            F.stddev_samp(value).alias(f"std_{i}"),
            F.min(value).alias(f"min_{i}"),
            F.max(value).alias(f"max_{i}"),
        ]
    return melt(
        df.agg(*aggregates),
        [
            {
                "column": F.lit(c),
                "n": F.col(f"n_{i}"),
                "nulls": F.col(f"null_{i}"),
                "nans": F.col(f"nan_{i}"),
                "mean": F.col(f"mean_{i}"),
                "stddev": F.col(f"std_{i}"),
                "min": F.col(f"min_{i}"),
                "max": F.col(f"max_{i}"),
            }
            for i, c in enumerate(cols)
        ],
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def domain_check(df: DataFrame, col: str, allowed: list) -> DataFrame:
    """(outside, ok): rows whose value is not in the allowed set; null counts as outside."""
    outside = ~F.coalesce(F.col(col).isin(allowed), F.lit(False))
    return df.agg(F.count_if(outside).alias("outside")).withColumn("ok", F.col("outside") == 0)


@dataclass(frozen=True)
class Expectations:
    """Rules for one table. Thresholds and names are the caller's."""

    min_rows: int = 1
    required: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    label: str | None = None
    label_domain: tuple = (0, 1)


def check_expectations(df: DataFrame, rules: Expectations) -> DataFrame:
    """(rule, observed, passed), one row per rule; all row-level rules share one aggregation."""
    there = set(df.columns)
    not_null = [c for c in rules.not_null if c in there]
    aggregates = [F.count(F.lit(1)).alias("rows")]
    aggregates += [F.count_if(is_null_or_nan(df, c)).alias(f"missing_{c}") for c in not_null]
    records = [
        {
            "rule": F.lit(f"rows >= {rules.min_rows}"),
            "observed": F.col("rows"),
            "passed": F.col("rows") >= rules.min_rows,
        }
    ]
    for c in [*rules.required, *rules.not_null]:
        if c in there and c in rules.not_null:
            continue
        records.append(
            {
                "rule": F.lit(f"column {c} present"),
                "observed": F.lit(int(c in there)).cast("bigint"),
                "passed": F.lit(c in there),
            }
        )
    for c in not_null:
        missing = F.col(f"missing_{c}")
        records.append({"rule": F.lit(f"{c} has no nulls"), "observed": missing, "passed": missing == 0})
    if rules.label is not None and rules.label in there:
        outside = ~F.coalesce(F.col(rules.label).isin(list(rules.label_domain)), F.lit(False))
        aggregates.append(F.count_if(outside).alias("outside"))
        domain = ", ".join(str(v) for v in rules.label_domain)
        records.append(
            {
                "rule": F.lit(f"{rules.label} in {{{domain}}}"),
                "observed": F.col("outside"),
                "passed": F.col("outside") == 0,
            }
        )
    return melt(df.agg(*aggregates), records)


def is_null_or_nan(df: DataFrame, name: str):
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return is_missing(name) if floating else F.col(name).isNull()


def vector_width(df: DataFrame, vector: str) -> DataFrame:
    """(min_width, max_width) of a vector column over all rows."""
    width = F.size(vector_to_array(vector))
    return df.agg(F.min(width).alias("min_width"), F.max(width).alias("max_width"))


def metric_range_check(metrics: DataFrame, cols: list[str]) -> DataFrame:
    """(metric, outside, ok): values not in [0, 1]; null and NaN count as outside."""
    counts = metrics.agg(
        *[F.count_if(~F.coalesce(F.col(c).between(0.0, 1.0), F.lit(False))).alias(c) for c in cols]
    )
    return melt(counts, [{"metric": F.lit(c), "outside": F.col(c), "ok": F.col(c) == 0} for c in cols])


def coverage_check(spark: SparkSession, dimension: DataFrame, code: str, groups: dict[str, list[str]]) -> DataFrame:
    """Dimension rows with the feature group that uses their code, or ``mapped`` false where none does."""
    rows = [(member, name) for name, members in groups.items() for member in members]
    mapping = spark.createDataFrame(rows, T.StructType([
        T.StructField(code, T.StringType()), T.StructField("feature_group", T.StringType())
    ]))
    joined = dimension.join(F.broadcast(mapping), code, "left")  # size fixed by the argument
    return joined.withColumn("mapped", F.col("feature_group").isNotNull())


def dataset_card(
    df: DataFrame,
    name: str,
    label: str,
    feature_groups: dict[str, list[str]],
    storage_format: str,
    partition_column: str,
    lineage: list[str],
) -> DataFrame:
    """One row that documents a dataset: size, classes, feature groups, storage and lineage."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(label) == 0).alias("n0"),
        F.count_if(F.col(label) == 1).alias("n1"),
    )
    first_group = next(iter(feature_groups.values()), [])
    return counts.select(
        F.lit(name).alias("dataset"),
        "total_rows",
        F.lit(len(first_group)).alias("num_features"),
        F.lit(label).alias("target_column"),
        F.struct(F.col("n0").alias("0_normal"), F.col("n1").alias("1_anomaly")).alias("class_distribution"),
        F.round(F.col("n0") / F.greatest(F.col("n1"), F.lit(1)), 2).alias("imbalance_ratio"),
        F.lit(storage_format).alias("storage_format"),
        F.lit(partition_column).alias("partition_column"),
        F.struct(*[
            F.array(*[F.lit(c) for c in cols]).cast("array<string>").alias(group)
            for group, cols in feature_groups.items()
        ]).alias("feature_groups"),
        F.struct(*[F.lit(text).alias(f"step{i}") for i, text in enumerate(lineage, 1)]).alias("lineage"),
    )


def feature_card(split_df: DataFrame, feature_cols: list[str], pca_components: int, label: str = "label") -> DataFrame:
    """One row: feature list, PCA width, balanced class weights and split sizes. Needs a ``split`` column."""
    counts = split_df.agg(
        F.count_if(F.col(label) == 0).alias("n0"),
        F.count_if(F.col(label) == 1).alias("n1"),
        *[F.count_if(F.col("split") == s).alias(s) for s in ("train", "val", "test")],
    )
    both = F.col("n0") + F.col("n1")
    return counts.select(
        F.array(*[F.lit(c) for c in feature_cols]).alias("feature_cols"),
        F.lit(len(feature_cols)).alias("n_features"),
        F.lit(pca_components).alias("pca_components"),
        F.struct((both / (2 * F.col("n0"))).alias("0"), (both / (2 * F.col("n1"))).alias("1")).alias("class_weights"),
        F.struct("train", "val", "test").alias("splits"),
    )
