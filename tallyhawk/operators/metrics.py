"""Classification metrics from four confusion cells per model.

Scored tables are long: (model, key, label, score, prediction). The rows are touched once, by one
aggregation whose result has one row per model; all metrics are closed forms over those cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhawk.functions.rows import melt
from tallyhawk.functions.scalars import percent, ratio_or_zero

CELLS = ("tp", "fp", "fn", "tn")

# Money value of each confusion cell.
CELL_VALUE = {"tp": 500, "fp": -50, "fn": -2000, "tn": 0}


def cell_flags(label: str = "label", prediction: str = "prediction") -> dict[str, Column]:
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    return {
        "tp": actual & predicted,
        "fp": ~actual & predicted,
        "fn": actual & ~predicted,
        "tn": ~actual & ~predicted,
    }


def confusion(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., tp, fp, fn, tn) per model."""
    flags = cell_flags()
    return scored.groupBy(*(by or ["model"])).agg(*[F.count_if(flags[c]).alias(c) for c in CELLS])


def weighted_confusion(scored: DataFrame, weight: str, by: list[str]) -> DataFrame:
    flags = cell_flags()
    return scored.groupBy(*by).agg(
        *[F.sum(F.when(flags[c], F.col(weight)).otherwise(0)).cast("bigint").alias(c) for c in CELLS]
    )


def _total() -> Column:
    return sum((F.col(c) for c in CELLS[1:]), F.col(CELLS[0]))


def confusion_shares(cells: DataFrame) -> DataFrame:
    """Cells with their share of all rows in percent."""
    return cells.withColumns({f"{c}_pct": percent(F.col(c), _total(), 4) for c in CELLS})


def _class_rates(hit: str, wrongly_in: str, missed: str) -> tuple[Column, Column, Column]:
    precision = ratio_or_zero(F.col(hit), F.col(hit) + F.col(wrongly_in))
    recall = ratio_or_zero(F.col(hit), F.col(hit) + F.col(missed))
    f1 = ratio_or_zero(2 * F.col(hit), 2 * F.col(hit) + F.col(wrongly_in) + F.col(missed))
    return precision, recall, f1


def class_report(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., class, precision, recall, f1, support), one row per class."""
    records = []
    for value, (hit, wrong, missed) in ((0, ("tn", "fn", "fp")), (1, ("tp", "fp", "fn"))):
        precision, recall, f1 = _class_rates(hit, wrong, missed)
        records.append(
            {
                "class": F.lit(value),
                "precision": precision,
                "recall": recall,
                "f1": f1,
                "support": F.col(hit) + F.col(missed),
            }
        )
    return melt(cells, records, by or ["model"])


def summary_metrics() -> dict[str, Column]:
    """Class-weighted F1, precision and recall, and accuracy, over cell columns."""
    p1, r1, f1 = _class_rates("tp", "fp", "fn")
    p0, r0, f0 = _class_rates("tn", "fn", "fp")
    positives, negatives = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    total = _total()

    def weighted(one: Column, zero: Column) -> Column:
        return ratio_or_zero(positives * one + negatives * zero, total)

    return {
        "f1": weighted(f1, f0),
        "accuracy": ratio_or_zero(F.col("tp") + F.col("tn"), total),
        "precision": weighted(p1, p0),
        "recall": weighted(r1, r0),
    }


def weighted_metrics(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., f1, accuracy, precision, recall); f1, precision and recall are class-weighted means."""
    metrics = summary_metrics()
    return cells.select(*(by or ["model"]), *[column.alias(name) for name, column in metrics.items()])


def money_value(cells: DataFrame, value: dict[str, float] | None = None) -> DataFrame:
    """Cells with ``total_value``: the sum over cells of count times value per case."""
    value = value or CELL_VALUE
    total = sum((F.col(c) * value[c] for c in CELLS[1:]), F.col(CELLS[0]) * value[CELLS[0]])
    return cells.withColumn("total_value", total)


def rank_models(table: DataFrame, criteria: list[str], name: str = "model") -> DataFrame:
    """Add ``rank_<criterion>`` (1 = highest) for each criterion. The input has one row per model."""
    return table.withColumns(
        {f"rank_{c}": F.rank().over(Window.orderBy(F.desc(c), F.asc(name))) for c in criteria}
    )


def relative_to_first(table: DataFrame, series: str, order: str, value: str) -> DataFrame:
    """Per series: the first value over each value (speed-up) and that per unit of ``order`` growth."""
    window = Window.partitionBy(series).orderBy(order)
    first_value, first_order = F.first(value).over(window), F.first(order).over(window)
    speedup = ratio_or_zero(first_value, F.col(value))
    growth = F.col(order) / first_order
    return table.withColumns(
        {"ideal": first_value / growth, "speedup": speedup, "efficiency": speedup / growth}
    )
