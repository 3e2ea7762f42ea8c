"""Joins to small dimensions and combinations of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def enrich(df: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Left join to a dimension. Spark broadcasts it if its size is below the session's threshold, else shuffles."""
    return df.join(dimension, on, "left")


def enrich_constant(df: DataFrame, dimension: DataFrame, on: str, value) -> DataFrame:
    """Add the literal key ``on`` and the attributes of its one dimension row, null if there is none.

    With a constant key there is nothing to join: the attributes come from a scalar subquery.
    """
    attributes = [c for c in dimension.columns if c != on]
    row = dimension.filter(F.col(on) == value).agg(F.first(F.struct(*attributes)).alias("_row")).scalar()
    out = df.withColumn(on, F.lit(value)).withColumn("_row", row)
    return out.withColumns({c: F.col("_row")[c] for c in attributes}).drop("_row")


def stack(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; all frames must have the same columns."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def stack_tagged(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union of tables with unequal columns, each tagged with its name; absent columns become null."""
    tagged = [frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()]
    out = tagged[0]
    for frame in tagged[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def best_row(df: DataFrame, metric: str, tie_break: str) -> DataFrame:
    """The row with the highest metric; of equals, the one with the smallest tie-break value."""
    return df.filter(F.col(metric).isNotNull()).orderBy(F.desc(metric), F.asc(tie_break)).limit(1)
