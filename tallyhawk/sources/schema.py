"""Build table schemas from column groups."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import types as T

from tallyhawk.operators.features import EVENT_CODES, PAIR_SOURCES, POWER_SOURCES, STATISTICS


def pair_names(sources: list[str]) -> list[str]:
    return [f"{a}_{b}_{kind}" for a, b in combinations(sources, 2) for kind in ("interaction", "ratio")]


def power_names(sources: list[str]) -> list[str]:
    return [f"{c}_{kind}" for c in sources for kind in ("squared", "cubed", "log")]


def table_schema(counts: list[str], label: str, *feature_groups: list[str] | tuple[str, ...]) -> T.StructType:
    """Nullable doubles for counts and features around one integer label, in file order."""
    doubles = [T.StructField(c, T.DoubleType(), True) for c in counts]
    rest = [T.StructField(c, T.DoubleType(), True) for group in feature_groups for c in group]
    return T.StructType([*doubles, T.StructField(label, T.IntegerType(), True), *rest])


def wide_event_schema() -> T.StructType:
    """The 81-column table: 29 counts, label, 9 statistics, 30 pair and 12 power columns."""
    return table_schema(EVENT_CODES, "Label", STATISTICS, pair_names(PAIR_SOURCES), power_names(POWER_SOURCES))
