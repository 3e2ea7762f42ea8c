"""Running totals and row numbers over a global order, without a single-task window.

A window with no (or a very skewed) partition key pulls a whole group into one task. Here each row
gets an order-preserving bucket computed from its value alone, the window runs inside
(group, bucket), and a small table of bucket totals supplies what came before. Buckets depend only
on data, never on physical placement, so re-run tasks and adaptive re-planning cannot change them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyhawk.functions.hashing import HASH_BITS

BUCKET = "_bucket"
GROUP = "_group"
RADIX = 8
POINTS_PER_BUCKET = 8


def default_buckets(spark: SparkSession) -> int:
    """At least two buckets per shuffle partition, so that they balance across tasks."""
    return _power_of_radix(2 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def _power_of_radix(wanted: int) -> int:
    buckets = RADIX
    while buckets < wanted:
        buckets *= RADIX
    return buckets


def quantile_bucket(df: DataFrame, order: str, counts: list[str], buckets: int | None = None) -> DataFrame:
    """Add ``_bucket``: how many of the approximate quantile bounds of ``order`` are <= the value.

    ``df`` is already grouped, so that (group, value) hardly repeats and buckets balance; ``counts`` are
    its aggregate columns. The bounds come from a scalar subquery that also looks at the counts: it then
    needs the very columns the main plan needs, and reads the same shuffle instead of scanning again.
    The number of buckets is rounded up to a power of eight. The lookup descends by one octal digit per
    level, with seven comparisons each, and stays inside generated code.

    Bounds are splitters of a sample sort: about the square root of the partitions' number of merging tasks each turn their share of
    the partial sketches into evenly spaced points, and of all points, eight per bucket, every eighth is a bound. No task merges all
    sketches, and what the last one sorts follows the number of buckets, not the rows.
    """
    spark = df.sparkSession
    buckets = _power_of_radix(buckets) if buckets else default_buckets(spark)
    merging = max(1, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    each = max(8, -(-POINTS_PER_BUCKET * buckets // merging))
    cuts = ", ".join(f"{(2 * i + 1) / (2 * each)!r}D" for i in range(each))
    used = sum((F.col(c) for c in counts[1:]), F.col(counts[0])) > -1
    sketches = df.filter(used).groupBy(F.pmod(F.spark_partition_id(), F.lit(merging)).alias("_m")).agg(
        F.expr(f"percentile_approx(`{order}`, array({cuts}), {20 * each})").alias("_points")
    )
    points = F.array_sort(F.flatten(F.collect_list("_points")))
    every = F.expr(f"transform(sequence(1, {buckets - 1}), i -> get(_all, cast(floor(cast(i as bigint) * size(_all) / {buckets}D) as int)))")
    bounds = sketches.agg(points.alias("_all")).select(every)
    placed = df.withColumn("_bounds", bounds.scalar()).withColumn("_at", F.lit(0))
    stride = buckets // RADIX
    while stride:
        passed = " + ".join(
            f"cast(get(_bounds, _at + {step * stride - 1}) <= `{order}` as int)" for step in range(1, RADIX)
        )
        placed = placed.withColumn("_at", F.expr(f"_at + {stride} * ({passed})"))
        stride //= RADIX
    return placed.withColumn(BUCKET, _never_null(F.col("_at"))).drop("_bounds", "_at")


def _never_null(bucket: Column) -> Column:
    """Nulls sort first, so they belong in bucket 0. A bucket known not to be null also keeps the optimizer
    from inferring a null check on it and evaluating the lookup once more on every input row."""
    return F.coalesce(bucket, F.lit(0))


def hash_prefix_bucket(hashed: Column, spark: SparkSession, buckets: int | None = None) -> Column:
    """Order-preserving bucket of a uniform hash: its leading bits. Needs no data pass, and no cap on the buckets."""
    buckets = buckets or _power_of_radix(2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bits = min(buckets.bit_length() - 1, HASH_BITS)
    return _never_null(F.shiftright(hashed, HASH_BITS - bits))


def group_key(group: list[str]) -> Column:
    """Group columns as one struct, which unlike bare columns also joins null with null."""
    return F.struct(*group) if group else F.struct(F.lit(0).alias("all"))


def running_totals(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    values: list[str],
    descending: bool = False,
) -> DataFrame:
    """Add ``run_<v>`` (inclusive running sum within the group) and ``tot_<v>`` for each value.

    ``df`` must carry ``_bucket``, monotone in the first order column, and ``order`` must be total
    within a group. ``descending`` says that both the order and the buckets run downwards.
    """
    keyed = df.withColumn(GROUP, group_key(group))
    inside = Window.partitionBy(GROUP, BUCKET).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = keyed.withColumns({f"run_{v}": F.sum(v).over(inside) for v in values})

    sums = keyed.groupBy(GROUP, BUCKET).agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
    whole = Window.partitionBy(GROUP)
    along = whole.orderBy(F.desc(BUCKET) if descending else F.asc(BUCKET))
    along = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = sums.select(
        GROUP,
        BUCKET,
        *[(F.sum(f"sum_{v}").over(along) - F.col(f"sum_{v}")).alias(f"before_{v}") for v in values],
        *[F.sum(f"sum_{v}").over(whole).alias(f"tot_{v}") for v in values],
    )
    joined = rows.join(before, [GROUP, BUCKET])
    joined = joined.withColumns({f"run_{v}": F.col(f"run_{v}") + F.col(f"before_{v}") for v in values})
    return joined.drop(GROUP, *[f"before_{v}" for v in values])


def rank_by_hash(df: DataFrame, strata: list[str], hashed: Column, key: str) -> DataFrame:
    """Add ``rank`` (1-based, by hash then key, within the stratum) and ``stratum_rows``.

    ``key`` identifies a row. Hash buckets then hold equal shares of every stratum, however large it is.
    """
    bucketed = df.withColumn("_hash", hashed)
    bucketed = bucketed.withColumn(BUCKET, hash_prefix_bucket(F.col("_hash"), df.sparkSession))
    bucketed = bucketed.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_totals(bucketed, strata, [F.asc("_hash"), F.asc(key)], ["_one"])
    ranked = ranked.withColumnsRenamed({"run__one": "rank", "tot__one": "stratum_rows"})
    return ranked.drop("_hash", "_one", BUCKET)
