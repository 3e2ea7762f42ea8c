"""Row-wise features: group sums, ratios, logs, flags, statistics, pairs and powers.

Every function adds all of its columns in one projection. Column names are arguments.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations
from operator import add

from pyspark.sql import DataFrame, functions as F

from tallyhawk.functions.scalars import column_sum, flag_above, guarded_ratio, missing_to_zero

STATISTICS = (
    "total_events",
    "mean_event_count",
    "std_event_count",
    "max_event_count",
    "min_event_count",
    "nonzero_events",
    "event_sparsity",
    "event_concentration",
    "event_balance",
)


def group_sums(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """One sum column per named group of columns; a null member makes the sum null."""
    return df.withColumns({name: column_sum(members) for name, members in groups.items()})


def row_statistics(df: DataFrame, cols: list[str]) -> DataFrame:
    """The nine ``STATISTICS`` over k count columns.

    The formulas are this library's own: std is the sample form, sparsity is the share of columns that
    are not positive, concentration is max / total, balance is min / max (0 where the divisor is not positive).
    """
    k = len(cols)
    first = df.withColumns(
        {
            "total_events": column_sum(cols).cast("double"),
            "max_event_count": F.greatest(*cols).cast("double"),
            "min_event_count": F.least(*cols).cast("double"),
            "nonzero_events": reduce(add, [(F.col(c) > 0).cast("double") for c in cols]),
        }
    )
    second = first.withColumns(
        {
            "mean_event_count": F.col("total_events") / k,
            "event_sparsity": 1 - F.col("nonzero_events") / k,
            "event_concentration": guarded_ratio("max_event_count", "total_events"),
            "event_balance": guarded_ratio("min_event_count", "max_event_count"),
        }
    )
    mean = F.col("mean_event_count")
    squares = reduce(add, [(F.col(c) - mean) * (F.col(c) - mean) for c in cols])
    return second.withColumn("std_event_count", F.sqrt(squares / (k - 1)))


def pair_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """For each pair a, b in order: ``a_b_interaction`` = a*b and ``a_b_ratio`` = a/(b+1) (own formulas)."""
    new = {}
    for a, b in combinations(cols, 2):
        new[f"{a}_{b}_interaction"] = F.col(a) * F.col(b).cast("double")
        new[f"{a}_{b}_ratio"] = F.col(a) / (F.col(b) + 1)
    return df.withColumns(new)


def power_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """``x_squared``, ``x_cubed`` and ``x_log`` = log1p(x) per column (own formulas)."""
    new = {}
    for c in cols:
        x = F.col(c).cast("double")
        new[f"{c}_squared"] = x * x
        new[f"{c}_cubed"] = x * x * x
        new[f"{c}_log"] = F.log1p(x)
    return df.withColumns(new)


def log_features(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({f"log_{c}": F.log1p(F.col(c)) for c in cols})


def flag_features(df: DataFrame, flags: dict[str, tuple[str, float]]) -> DataFrame:
    """``{new: (column, threshold)}`` -> 1.0 where strictly above the threshold, else 0.0."""
    return df.withColumns({name: flag_above(c, threshold) for name, (c, threshold) in flags.items()})


def zero_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null or NaN becomes 0 in all the columns, in one projection."""
    return df.withColumns({c: missing_to_zero(F.col(c).cast("double")) for c in cols})


@dataclass(frozen=True)
class FeaturePlan:
    """Which columns feed which features. ``names`` is the ordered, duplicate-free feature list."""

    counts: list[str]
    groups: dict[str, list[str]]
    ratios: dict[str, tuple[str, str]] = field(default_factory=dict)
    logs: list[str] = field(default_factory=list)
    flags: dict[str, tuple[str, float]] = field(default_factory=dict)
    pairs: list[str] = field(default_factory=list)
    powers: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)
    statistics_given: bool = False
    pairs_given: list[str] = field(default_factory=list)

    @property
    def imputed(self) -> list[str]:
        """Columns that exist before feature building and get their gaps filled by the median."""
        return [*self.counts, *(STATISTICS if self.statistics_given else []), *self.extra]

    @property
    def names(self) -> list[str]:
        derived = [f"{a}_{b}_{kind}" for a, b in combinations(self.pairs, 2) for kind in ("interaction", "ratio")]
        powers = [f"{c}_{kind}" for c in self.powers for kind in ("squared", "cubed", "log")]
        ordered = [
            *self.counts,
            *STATISTICS,
            *self.groups,
            *self.ratios,
            *[f"log_{c}" for c in self.logs],
            *self.flags,
            *derived,
            *self.pairs_given,
            *powers,
            *self.extra,
        ]
        return list(dict.fromkeys(ordered))


def engineer(df: DataFrame, plan: FeaturePlan) -> DataFrame:
    """All row-wise features of a plan, in order: sums, statistics, ratios, logs, flags, pairs, powers."""
    out = group_sums(df, plan.groups)
    if not plan.statistics_given:
        out = row_statistics(out, plan.counts)
    out = out.withColumns({name: guarded_ratio(n, d) for name, (n, d) in plan.ratios.items()})
    out = log_features(out, plan.logs)
    out = flag_features(out, plan.flags)
    if plan.pairs:
        out = pair_features(out, plan.pairs)
    if plan.powers:
        out = power_features(out, plan.powers)
    return out


# The column plan of the wide 29-event table.
EVENT_CODES = [f"E{i}" for i in range(1, 30)]
EVENT_GROUPS = {
    "cat_data_transfer": ["E2", "E5", "E9", "E11", "E21", "E23", "E25", "E26"],
    "cat_error": ["E4", "E6", "E7", "E8", "E22"],
    "cat_replication": ["E3", "E15", "E16", "E19"],
    "cat_admin": ["E14", "E18", "E24", "E27", "E28", "E29"],
}
EVENT_PAIRS = [
    "E5_E26_interaction", "E5_E26_ratio",
    "E5_E11_interaction", "E5_E11_ratio",
    "E5_E9_interaction", "E5_E9_ratio",
    "E11_E9_interaction", "E11_E9_ratio",
]
PAIR_SOURCES = ["E5", "E26", "E11", "E9", "E21", "E23"]
POWER_SOURCES = ["E5", "E26", "E11", "E9"]


def wide_event_plan() -> FeaturePlan:
    """Plan for the 29-event table whose statistics and pair columns are already in the file (56 features)."""
    return FeaturePlan(
        counts=EVENT_CODES,
        groups=EVENT_GROUPS,
        ratios={"error_ratio": ("cat_error", "total_events")},
        logs=["total_events", "cat_data_transfer", "cat_error"],
        flags={"has_error": ("cat_error", 0.0), "high_sparsity": ("event_sparsity", 0.7)},
        pairs_given=EVENT_PAIRS,
        statistics_given=True,
    )
