"""Exploratory aggregates over whole tables, in place of plots of a driver-side sample."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, functions as F

from tallyhawk.functions.rows import melt
from tallyhawk.functions.scalars import present


def group_mean(df: DataFrame, by: str, value: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias(f"mean_{value}"))


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x, y, r): Pearson correlation of each pair on the rows where both are present, in one pass."""
    pairs = list(combinations_with_replacement(cols, 2))
    values = {c: present(F.col(c).cast("double")) for c in cols}
    wide = df.agg(*[F.corr(values[x], values[y]).alias(f"r_{i}") for i, (x, y) in enumerate(pairs)])
    upper = [{"x": F.lit(x), "y": F.lit(y), "r": F.col(f"r_{i}")} for i, (x, y) in enumerate(pairs)]
    lower = [{"x": F.lit(y), "y": F.lit(x), "r": F.col(f"r_{i}")} for i, (x, y) in enumerate(pairs) if x != y]
    return melt(wide, upper + lower)


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """(bin, lower, upper, n): equal-width bins from minimum to maximum, empty bins included.

    The maximum belongs to the last bin; a constant column gets a range of width one around it.
    """
    spark = df.sparkSession
    value = present(F.col(col).cast("double"))
    edges = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    constant = F.col("lo") == F.col("hi")
    edges = edges.select(
        F.struct(
            F.when(constant, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(constant, F.lit(1.0)).otherwise(F.col("hi") - F.col("lo")).alias("span"),
        )
    ).scalar()
    lo, span = edges.getField("lo"), edges.getField("span")
    place = F.least(F.floor((value - lo) / span * bins), F.lit(bins - 1)).cast("bigint")
    counts = df.filter(value.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = spark.range(bins).withColumnRenamed("id", "bin").join(counts, "bin", "left")
    return frame.select(
        "bin",
        (lo + span * F.col("bin") / bins).alias("lower"),
        (lo + span * (F.col("bin") + 1) / bins).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def top_rows(df: DataFrame, by: list, k: int) -> DataFrame:
    """First ``k`` rows in a total order; planned as a per-task top-k, not a full sort."""
    return df.orderBy(*by).limit(k)
