"""Column expressions used across operators. All are built-ins inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_missing(value: Column | str) -> Column:
    """Null or NaN."""
    value = as_col(value)
    return value.isNull() | F.isnan(value)


def present(value: Column | str) -> Column:
    """The value, with NaN turned into null so that aggregates skip it."""
    value = as_col(value)
    return F.when(~F.isnan(value), value)


def missing_to_zero(value: Column | str) -> Column:
    value = as_col(value)
    return F.when(is_missing(value), 0.0).otherwise(value)


def column_sum(names: list[str]) -> Column:
    """Sum of columns; one null makes the sum null, so impute first."""
    return reduce(add, [F.col(name) for name in names])


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator where the denominator is positive, else 0."""
    numerator, denominator = as_col(numerator), as_col(denominator)
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def flag_above(value: Column | str, threshold: float) -> Column:
    """1.0 where the value is strictly above the threshold, else 0.0."""
    return (as_col(value) > threshold).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part / whole * 100, digits)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Ratio of counts, with 0/0 taken as 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def positive_score(df: DataFrame, probability: str = "probability", raw: str = "rawPrediction") -> Column:
    """Score of the positive class: its probability, or its raw margin for models without one."""
    return vector_to_array(probability if probability in df.columns else raw)[1]
