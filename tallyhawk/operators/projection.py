"""Covariances of a vector column as a relation, and whether a projection's directions are its eigenvectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F


def covariance_cells(df: DataFrame, vector: str, width: int) -> DataFrame:
    """(i, j, cov): sample covariance of every two places of a vector column, one pass.

    A task sums the products of its rows as one matrix and emits a row per cell, so the shuffle holds tasks x width x width rows
    whatever the table's size. Values should be about centred, as standardised ones are. The mean is shifted by the cells' own sums.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count, product = np.zeros(width), 0, np.zeros((width, width))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            total += x.sum(axis=0)
            product += x.T @ x
            count += len(x)
        if count:
            i, j = np.divmod(np.arange(width * width), width)
            columns = [i.astype(np.int32), j.astype(np.int32), product.ravel(), total[i], total[j], np.full(len(i), count, dtype=np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "xy", "x", "y", "n"])

    rows = df.select(vector_to_array(vector).alias("x"))
    parts = rows.mapInArrow(products, "i int, j int, xy double, x double, y double, n long")
    summed = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("xy", "x", "y", "n")])
    return summed.select("i", "j", ((F.col("xy") - F.col("x") * F.col("y") / F.col("n")) / (F.col("n") - 1)).alias("cov"))


def eigen_check(cells: DataFrame, model: PCAModel) -> DataFrame:
    """(component, variance, residual, length) of every direction v of ``model``: v' C v, the greatest component of C v - variance * v by
    size, and |v|. All three follow from the covariance relation; an eigenvector's residual is 0."""
    spark = cells.sparkSession
    directions = model.pc.toArray()
    entries = [(c + 1, j, float(directions[j, c])) for c in range(directions.shape[1]) for j in range(directions.shape[0])]
    table = spark.createDataFrame(entries, "component int, j int, v double")
    image = cells.join(table, "j").groupBy("component", F.col("i").alias("j")).agg(F.sum(F.col("cov") * F.col("v")).alias("cv"))
    both = image.join(table, ["component", "j"])
    variance = both.groupBy("component").agg(F.sum(F.col("cv") * F.col("v")).alias("variance"), F.sum(F.col("v") * F.col("v")).alias("length"))
    off = F.abs(F.col("cv") - F.col("variance") * F.col("v"))
    return both.join(variance, "component").groupBy("component").agg(
        F.max("variance").alias("variance"), F.max(off).alias("residual"), F.sqrt(F.max("length")).alias("length")
    )


def projection_report(df: DataFrame, vector: str, model: PCAModel, tolerance: float = 1e-6) -> DataFrame:
    """(component, variance, share, cumulative, n_varying, is_eigenvector, share_agrees): each direction of a fitted projection against the covariances of ``vector``
    in ``df``, the rows it was fitted on.

    ``n_varying`` is the sum of all variances, which for standardised columns is how many of them vary. ``share_agrees`` says that the share
    the model reports is the direction's variance over that sum.
    """
    cells = covariance_cells(df, vector, model.pc.numRows)
    total = cells.filter("i = j").agg(F.sum("cov")).scalar()
    reported = [(c + 1, float(s)) for c, s in enumerate(model.explainedVariance.toArray())]
    running = np.cumsum([s for _, s in reported])
    shares = df.sparkSession.createDataFrame([(c, s, float(t)) for (c, s), t in zip(reported, running)], "component int, share double, cumulative double")
    checked = eigen_check(cells, model).join(shares, "component").withColumn("n_varying", total)
    eigenvector = (F.col("residual") <= tolerance * F.greatest(F.col("n_varying"), F.lit(1.0))) & (F.abs(F.col("length") - 1) <= tolerance)
    agrees = F.abs(F.col("variance") - F.col("share") * F.col("n_varying")) <= tolerance * F.greatest(F.col("n_varying"), F.lit(1.0))
    return checked.select(
        "component", "variance", "share", "cumulative", "n_varying", eigenvector.alias("is_eigenvector"), agrees.alias("share_agrees")
    )
