"""Exact quantiles of many columns, by distributed rank selection.

The built-in exact ``percentile`` keeps every distinct value of a group in one task's memory, and
MLlib's ``Imputer`` at zero error sends its whole summary to the driver. Here values are counted,
given global running counts (see ``prefix``) and the rows at the wanted ranks are kept.
Per group, only values inside narrow bands are put in order at all. Nulls and NaNs are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhawk.functions.scalars import present
from tallyhawk.operators.prefix import quantile_bucket, running_totals
from tallyhawk.session import cut_lineage

BAND_ACCURACY = 10_000


def value_counts(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """(by..., feature, value, n): one row per distinct value of each column, counted map-side first."""
    by = by or []
    pairs = [F.struct(F.lit(c).alias("feature"), present(F.col(c).cast("double")).alias("value")) for c in cols]
    long = df.select(*by, F.explode(F.array(*pairs)).alias("_p")).select(*by, "_p.*")
    counted = long.filter(F.col("value").isNotNull()).groupBy(*by, "feature", "value")
    return counted.agg(F.count(F.lit(1)).alias("n"))


def _narrowed_counts(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Value counts that stay detailed only near the wanted quantiles.

    A first pass finds bands that surely hold each quantile (the sketch's rank error is bounded by
    1/accuracy; the bands are four times as wide). Values between bands fall into one row per gap
    that keeps its count, minimum and maximum, so a heavy shuffle of all values is avoided.
    """
    margin = 4.0 / BAND_ACCURACY
    edges = sorted({min(max(p + side * margin, 0.0), 1.0) for p in probs for side in (-1, 1)})
    sketch = df.agg(
        F.struct(
            *[F.percentile_approx(present(F.col(c).cast("double")), edges, BAND_ACCURACY).alias(f"c{i}")
              for i, c in enumerate(cols)]
        )
    ).scalar()
    bands = [(edges.index(lo), edges.index(hi)) for lo, hi in _merged_bands(probs, margin)]
    structs = []
    for i, c in enumerate(cols):
        value = present(F.col(c).cast("double"))
        edge = F.col("_sketch")[f"c{i}"]
        gap = F.lit(-1)  # inside a band
        inside = F.lit(False)
        passed = F.lit(0)
        for lo, hi in bands:
            inside = inside | value.between(edge[lo], edge[hi])
            passed = passed + (value > edge[hi]).cast("int")
        gap = F.when(inside, gap).otherwise(passed)
        structs.append(
            F.struct(
                F.lit(c).alias("feature"),
                gap.alias("gap"),
                F.when(inside, value).alias("key"),
                value.alias("value"),
            )
        )
    marked = df.select(*cols).withColumn("_sketch", sketch)
    long = marked.select(F.explode(F.array(*structs)).alias("_p")).select("_p.*").filter(F.col("value").isNotNull())
    return long.groupBy("feature", "gap", "key").agg(
        F.min("value").alias("value"), F.max("value").alias("value_max"), F.count(F.lit(1)).alias("n")
    )


def _merged_bands(probs: list[float], margin: float) -> list[tuple[float, float]]:
    bands: list[tuple[float, float]] = []
    for p in sorted(set(probs)):
        lo, hi = max(p - margin, 0.0), min(p + margin, 1.0)
        if bands and lo <= bands[-1][1]:
            bands[-1] = (bands[-1][0], hi)
        else:
            bands.append((lo, hi))
    return bands


def _rank_window(p: float, total: Column, method: str) -> tuple[Column, Column, Column]:
    """0-based lower rank, upper rank and interpolation weight of quantile ``p``."""
    if method == "linear":
        position = F.lit(p) * (total - 1)
        low = F.floor(position)
        return low, F.ceil(position), position - low
    low = F.greatest(F.ceil(F.lit(p) * total) - 1, F.lit(0))
    return low, low, F.lit(0.0)


def select_ranks(ranked: DataFrame, by: list[str], probs: list[float], method: str) -> DataFrame:
    """(by..., feature, p, q) from value counts that carry ``run_n`` and ``tot_n``."""
    run, count, total = F.col("run_n"), F.col("n"), F.col("tot_n")
    before = run - count
    wanted = [(p, *_rank_window(p, total, method)) for p in probs]

    def holds(rank: Column) -> Column:
        return (rank >= before) & (rank < run)

    def value_at(rank: Column) -> Column:
        exact = F.col("value") == F.col("value_max")
        return (
            F.when(~holds(rank), F.lit(None).cast("double"))
            .when(exact | (rank == before), F.col("value"))
            .when(rank == run - 1, F.col("value_max"))
            .otherwise(F.raise_error(F.lit("quantile rank fell between bands")).cast("double"))
        )

    near = F.lit(False)
    for _, low, high, _ in wanted:
        near = near | holds(low) | holds(high)
    picks = [
        F.struct(
            F.lit(p).alias("p"),
            value_at(low).alias("low"),
            value_at(high).alias("high"),
            weight.alias("weight"),
        )
        for p, low, high, weight in wanted
    ]
    hits = ranked.filter(near).select(*by, "feature", F.explode(F.array(*picks)).alias("_p"))
    hits = hits.select(*by, "feature", "_p.*").filter(F.col("low").isNotNull() | F.col("high").isNotNull())
    ends = hits.groupBy(*by, "feature", "p").agg(
        F.max("low").alias("low"), F.max("high").alias("high"), F.max("weight").alias("weight")
    )
    return ends.select(*by, "feature", "p", (F.col("low") + F.col("weight") * (F.col("high") - F.col("low"))).alias("q"))


def exact_quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    by: list[str] | None = None,
    method: str = "linear",
) -> DataFrame:
    """(by..., feature, p, q). ``linear`` interpolates between ranks, ``lower`` returns a data value."""
    if method not in ("linear", "lower"):
        raise ValueError(f"unknown quantile method {method!r}")
    by = by or []
    if by:
        return _grouped_quantiles(df, cols, probs, by, method)
    counts = _narrowed_counts(df, cols, probs)
    ranked = running_totals(quantile_bucket(counts, "value", ["n"]), [*by, "feature"], [F.asc("value")], ["n"])
    return select_ranks(ranked, by, probs, method)


def _grouped_quantiles(df: DataFrame, cols: list[str], probs: list[float], by: list[str], method: str) -> DataFrame:
    """Quantiles per group from bands that surely hold the wanted ranks.

    One sketch per group and column, merged map-side, gives the bands. A second pass counts per group what lies below each band, a third
    counts the values inside by value, and only these few are put in order. Sketches have a row per group and are stored, so that
    Spark knows their size when it plans the joins with the rows.
    """
    margin = 4.0 / BAND_ACCURACY
    bands = _merged_bands(probs, margin)
    edges = [edge for band in bands for edge in band]
    values = {i: present(F.col(c).cast("double")) for i, c in enumerate(cols)}
    sketch = df.groupBy(*by).agg(*[F.percentile_approx(v, edges, BAND_ACCURACY).alias(f"_s{i}") for i, v in values.items()])
    flat = [F.get(f"_s{i}", F.lit(k)).alias(f"_e{i}_{k}") for i in values for k in range(len(edges))]
    marked = _null_safe_join(df.select(*by, *[v.alias(f"_v{i}") for i, v in values.items()]), cut_lineage(sketch.select(*by, *flat)), by)

    places = [(i, k) for i in values for k in range(len(bands))]
    below = marked.groupBy(*by).agg(
        *[F.count(f"_v{i}").alias(f"_n{i}") for i in values],
        *[F.count_if(F.col(f"_v{i}") < F.col(f"_e{i}_{2 * k}")).alias(f"_b{i}_{k}") for i, k in places],
    )
    records = [F.struct(F.lit(cols[i]).alias("feature"), F.lit(k).alias("band"), F.col(f"_n{i}").alias("total"), F.col(f"_b{i}_{k}").alias("before")) for i, k in places]
    below = below.select(*by, F.explode(F.array(*records)).alias("_r")).select(*by, "_r.*")

    def band_of(i: int) -> Column:
        chosen = F.lit(None).cast("int")
        for k in range(len(bands)):
            chosen = F.when(F.col(f"_v{i}").between(F.col(f"_e{i}_{2 * k}"), F.col(f"_e{i}_{2 * k + 1}")), F.lit(k)).otherwise(chosen)
        return chosen

    found = marked.select(*by, *[f"_v{i}" for i in values], *[band_of(i).alias(f"_k{i}") for i in values])
    inside = [F.struct(F.lit(cols[i]).alias("feature"), F.col(f"_k{i}").alias("band"), F.col(f"_v{i}").alias("value")) for i in values]
    inside = found.select(*by, F.explode(F.array(*inside)).alias("_r")).filter(F.col("_r.band").isNotNull()).select(*by, "_r.*")
    counts = inside.groupBy(*by, "feature", "band", "value").agg(F.count(F.lit(1)).alias("n"))

    keys = [*by, "feature", "band"]
    # a band holds about a thousandth of its group's rows, counted by value
    along = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumns({"run_n": F.sum("n").over(along), "tot_n": F.sum("n").over(Window.partitionBy(*keys))})
    ranked = _null_safe_join(ranked, below, keys)
    run, before = F.col("before") + F.col("run_n"), F.col("before") + F.col("run_n") - F.col("n")
    picks = []
    for p in probs:
        band = next(k for k, (low, high) in enumerate(bands) if low <= p <= high)
        low, high, weight = _rank_window(p, F.col("total"), method)

        def at(rank: Column) -> Column:
            return F.when((rank >= before) & (rank < run), F.col("value"))

        outside = (low < F.col("before")) | (high >= F.col("before") + F.col("tot_n"))
        checked = F.when(outside, F.raise_error(F.lit("quantile rank fell outside its band")).cast("double")).otherwise(weight)
        picks.append(F.when(
            F.col("band") == band, F.struct(F.lit(p).alias("p"), at(low).alias("low"), at(high).alias("high"), checked.cast("double").alias("weight"))
        ))
    hits = ranked.select(*by, "feature", F.explode(F.array(*picks)).alias("_p")).filter(F.col("_p").isNotNull()).select(*by, "feature", "_p.*")
    ends = hits.groupBy(*by, "feature", "p").agg(*[F.max(c).alias(c) for c in ("low", "high", "weight")])
    return ends.select(*by, "feature", "p", (F.col("low") + F.col("weight") * (F.col("high") - F.col("low"))).alias("q"))


def box_statistics(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (outermost values inside the fences) and outlier count per group.

    The quartiles come out of bands and have a row per group and column. They are stored and joined to the rows once more, where whiskers and
    outliers are aggregates that combine map-side. No step shuffles the values.
    """
    quarters = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    quartiles = exact_quantiles(df, cols, [p for _, p in quarters], by).groupBy(*by).agg(*[
        F.max(F.when((F.col("feature") == c) & (F.col("p") == p), F.col("q"))).alias(f"_{name}{i}")
        for i, c in enumerate(cols) for name, p in quarters
    ])
    iqr = [F.col(f"_q3{i}") - F.col(f"_q1{i}") for i in range(len(cols))]
    fences = {}
    for i in range(len(cols)):
        fences |= {f"_lo{i}": F.col(f"_q1{i}") - 1.5 * iqr[i], f"_hi{i}": F.col(f"_q3{i}") + 1.5 * iqr[i]}
    values = [present(F.col(c).cast("double")).alias(f"_v{i}") for i, c in enumerate(cols)]
    marked = _null_safe_join(df.select(*by, *values), cut_lineage(quartiles.withColumns(fences)), by)
    aggregates, records = [], []
    for i, c in enumerate(cols):
        value = F.col(f"_v{i}")
        inside = value.between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))
        aggregates += [
            F.count(value).alias(f"n{i}"), *[F.first(f"_{name}{i}").alias(f"{name}{i}") for name, _ in quarters],
            F.min(F.when(inside, value)).alias(f"low{i}"), F.max(F.when(inside, value)).alias(f"high{i}"), F.count_if(~inside).alias(f"out{i}"),
        ]
        fields = {"n": "n", "q1": "q1", "median": "median", "q3": "q3", "whisker_low": "low", "whisker_high": "high", "outliers": "out"}
        records.append(F.struct(F.lit(c).alias("feature"), *[F.col(f"{short}{i}").alias(name) for name, short in fields.items()]))
    summed = marked.groupBy(*by).agg(*aggregates)
    return summed.select(*by, F.explode(F.array(*records)).alias("_r")).select(*by, "_r.*").filter("n > 0")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    left = left.withColumn("_k", F.struct(*keys))
    right = right.withColumn("_k", F.struct(*keys)).drop(*keys)
    return left.join(right, "_k").drop("_k")
