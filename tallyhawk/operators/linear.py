"""Linear classifiers as numbers: scores from coefficients, and the gradient of the training loss at them in one pass.

A fit by iteration has no closed form, but its result can be checked: at the optimum of a convex loss the gradient is
zero. The gradient is a sum over rows, one partial sum per coefficient and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F


def margin(features: Column, coefficients: Sequence[float], intercept: float) -> Column:
    """The raw score of an array of features."""
    terms = (features[i] * F.lit(float(c)) for i, c in enumerate(coefficients))
    return sum(terms, F.lit(float(intercept)))


def logistic_score(features: Column, coefficients: Sequence[float], intercept: float) -> Column:
    return 1 / (1 + F.exp(-margin(features, coefficients, intercept)))


def _inputs(rows: DataFrame, features: str, label: str, weight: str | None) -> DataFrame:
    weight = F.col(weight).cast("double") if weight else F.lit(1.0)
    return rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), weight.alias("w"))


def _sums(value: Column, width: int) -> Column:
    """Sums of value * x over all features, and of value alone behind them."""
    return F.array(*[F.sum(value * F.col("x")[i]) for i in range(width)], F.sum(value))


def logistic_gradient(
    rows: DataFrame, coefficients: Sequence[float], intercept: float, reg_param: float,
    features: str = "std_features", label: str = "label", weight: str | None = "class_weight",
) -> DataFrame:
    """One row (gradient, at_zero): the greatest partial derivative, by size, of the weighted mean logistic loss with a squared
    penalty on the coefficients, at the fit and at all zeros."""
    width = len(coefficients)
    data = _inputs(rows, features, label, weight)
    data = data.withColumns({
        "fit": F.col("w") * (logistic_score(F.col("x"), coefficients, intercept) - F.col("y")),
        "zero": F.col("w") * (F.lit(0.5) - F.col("y")),
    })
    summed = data.agg(_sums(F.col("fit"), width).alias("fit"), _sums(F.col("zero"), width).alias("zero"), F.sum("w").alias("w"))
    penalty = F.array(*[F.lit(float(reg_param * c)) for c in coefficients], F.lit(0.0))
    at_fit = F.zip_with("fit", penalty, lambda s, p: F.abs(s / F.col("w") + p))
    return summed.select(
        F.array_max(at_fit).alias("gradient"), F.array_max(F.transform("zero", lambda s: F.abs(s / F.col("w")))).alias("at_zero")
    )


def hinge_gradient(
    rows: DataFrame, coefficients: Sequence[float], intercept: float, reg_param: float, near: float = 0.02,
    features: str = "std_features", label: str = "label", weight: str | None = "class_weight",
) -> DataFrame:
    """The same for the hinge loss with a squared penalty on the coefficients of features scaled to unit deviation.

    The loss has a kink where a row's margin is 1. A row within ``near`` of it may count with any share of its slope, so every
    partial derivative is an interval; what is returned is the greatest distance of an interval from zero.
    """
    width = len(coefficients)
    data = _inputs(rows, features, label, weight).withColumn("side", 2 * F.col("y") - 1)
    gap = 1 - F.col("side") * margin(F.col("x"), coefficients, intercept)
    data = data.withColumns({
        "sure": F.when(gap > near, -F.col("w") * F.col("side")).otherwise(0.0),
        "open": F.when(F.abs(gap) <= near, -F.col("w") * F.col("side")).otherwise(0.0),
        "zero": -F.col("w") * F.col("side"),
    })
    one = [*[F.col("x")[i] for i in range(width)], F.lit(1.0)]
    low = F.array(*[F.sum(F.least(F.col("open") * x, F.lit(0.0))) for x in one])
    high = F.array(*[F.sum(F.greatest(F.col("open") * x, F.lit(0.0))) for x in one])
    summed = data.agg(
        _sums(F.col("sure"), width).alias("sure"), low.alias("low"), high.alias("high"), _sums(F.col("zero"), width).alias("zero"),
        _sums(F.col("w"), width).alias("mean"),
        F.array(*[F.sum(F.col("w") * F.col("x")[i] * F.col("x")[i]) for i in range(width)]).alias("square"),
    )
    w = F.get("mean", F.lit(width))
    parts = []
    for i, c in enumerate([*coefficients, None]):
        penalty = F.lit(0.0)
        if c is not None:
            mean = F.col("mean")[i] / w
            penalty = F.lit(float(reg_param * c)) * (F.col("square")[i] / w - mean * mean)
        least = (F.col("sure")[i] + F.col("low")[i]) / w + penalty
        most = (F.col("sure")[i] + F.col("high")[i]) / w + penalty
        parts.append(F.greatest(F.lit(0.0), least, -most))
    return summed.select(
        F.array_max(F.array(*parts)).alias("gradient"), F.array_max(F.transform("zero", lambda s: F.abs(s / w))).alias("at_zero")
    )
