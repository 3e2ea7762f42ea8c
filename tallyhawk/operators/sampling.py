"""Samples, splits, folds, class weights, oversampling and bootstrap weights.

All choices hang on a hash of the row key, so they do not change when rows move between partitions. Splits, samples and
folds hash with salts of their own: a sample of a split has its share of it.
"""

from __future__ import annotations

from math import isclose

from pyspark.sql import Column, DataFrame, functions as F

from tallyhawk.functions.hashing import hash_bound, key_bucket, key_hash, poisson_one, salt_for, unit_hash
from tallyhawk.functions.scalars import percent
from tallyhawk.operators.prefix import rank_by_hash
from tallyhawk.operators.quality import class_pair

LADDER = (0.1, 0.2, 0.4, 0.6, 0.8, 1.0)


def bernoulli_sample(df: DataFrame, key: str, fraction: float, seed: int | None = None) -> DataFrame:
    """Each key is in or out by its hash; samples of growing fractions are nested."""
    return df.filter(key_hash(key, salt_for("sample", seed)) < hash_bound(fraction))


def stratified_sample(df: DataFrame, key: str, label: str, fraction: float, seed: int | None = None) -> DataFrame:
    """The first ceil(fraction * n) keys of each class in hash order: exact shares in every class."""
    ranked = rank_by_hash(df, [label], key_hash(key, salt_for("sample", seed)), key)
    return ranked.filter(F.col("rank") <= F.ceil(F.col("stratum_rows") * fraction)).drop("rank", "stratum_rows")


def fraction_ladder(df: DataFrame, key: str, fractions: tuple[float, ...] = LADDER, seed: int | None = None) -> DataFrame:
    """One pass: each row once per fraction that admits it, tagged ``frac``; the samples are nested."""
    bucket = key_hash(key, salt_for("sample", seed))
    bounds = F.array(*[F.struct(F.lit(f).alias("frac"), F.lit(hash_bound(f)).alias("bound")) for f in fractions])
    admitted = F.filter(bounds, lambda step: F.col("_bucket") < step["bound"])
    tagged = df.withColumn("_bucket", bucket).withColumn("_step", F.explode(admitted))
    return tagged.withColumn("frac", F.col("_step.frac")).drop("_bucket", "_step")


def split_by_key(
    df: DataFrame,
    key: str,
    weights: dict[str, float] | None = None,
    seed: int | None = None,
) -> DataFrame:
    """Add ``split``. Default 60/20/20 train, val, test; bounds are half-open. No shuffle."""
    weights = weights or {"train": 0.6, "val": 0.2, "test": 0.2}
    if not isclose(sum(weights.values()), 1.0):
        raise ValueError("split weights must add up to 1")
    df = df.withColumn("_bucket", key_hash(key, salt_for("split", seed)))
    names = list(weights)
    choice: Column = F.lit(names[-1])
    bound = sum(weights.values())
    for name, following in zip(reversed(names[:-1]), reversed(names[1:])):
        bound -= weights[following]
        choice = F.when(F.col("_bucket") < hash_bound(bound), name).otherwise(choice)
    return df.withColumn("split", choice).drop("_bucket")


def split_audit(df: DataFrame, label: str = "label") -> DataFrame:
    """(split, label, n, split_rows, pct_of_split, pct_of_all)."""
    counts = df.groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("split").agg(F.sum("n").alias("split_rows"))
    everything = counts.agg(F.sum("n")).scalar()
    # Both sides hold at most (splits x classes) rows.
    joined = counts.join(totals, "split")
    return joined.select(
        "split",
        label,
        "n",
        "split_rows",
        percent(F.col("n"), F.col("split_rows"), 4).alias("pct_of_split"),
        percent(F.col("split_rows"), everything, 4).alias("pct_of_all"),
    )


def oversample_minority(
    df: DataFrame,
    label: str = "label",
    threshold: float = 2.0,
    partitions: int | None = None,
) -> DataFrame:
    """Repeat class 1 so that it has int(n0/n1) copies, if n0/n1 > threshold and class 1 exists.

    Copies come from one ``explode`` over one scan, not from a union that rescans per copy.
    """
    pair = class_pair(df, label).select(
        F.when(
            (F.col("n1") > 0) & (F.col("n0") / F.greatest(F.col("n1"), F.lit(1)) > threshold),
            F.floor(F.col("n0") / F.greatest(F.col("n1"), F.lit(1))),
        ).otherwise(F.lit(1)).cast("int")
    )
    copies = F.when(F.col(label) == 1, pair.scalar()).otherwise(F.lit(1))
    out = df.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return out.repartition(partitions) if partitions else out


def class_weights(
    df: DataFrame, label: str = "label", out: str = "class_weight", counted: DataFrame | None = None
) -> DataFrame:
    """Attach (n0+n1)/(2 n_class) per row, counted over ``counted`` if given; only one class is an error."""
    n0, n1 = F.col("n0"), F.col("n1")
    one_class = F.raise_error(F.lit("class weights need rows of both classes")).cast("double")
    pair = class_pair(df if counted is None else counted, label).select(
        F.struct(
            F.when(n0 * n1 == 0, one_class).otherwise((n0 + n1) / (2 * n0)).alias("w0"),
            F.when(n0 * n1 == 0, one_class).otherwise((n0 + n1) / (2 * n1)).alias("w1"),
        )
    ).scalar()
    return df.withColumn(out, F.when(F.col(label) == 0, pair.getField("w0")).otherwise(pair.getField("w1")))


def hash_folds(df: DataFrame, key: str, folds: int, seed: int | None = None) -> DataFrame:
    """Fold by key hash alone: no shuffle, classes balanced in expectation."""
    return df.withColumn("fold", key_bucket(key, folds, salt_for("fold", seed)).cast("int"))


def stratified_folds(df: DataFrame, key: str, label: str, folds: int, seed: int | None = None) -> DataFrame:
    """Fold = rank by key hash within the class, modulo ``folds``: class counts differ by at most one."""
    ranked = rank_by_hash(df, [label], key_hash(key, salt_for("fold", seed)), key)
    return ranked.withColumn("fold", F.pmod(F.col("rank") - 1, F.lit(folds)).cast("int")).drop("rank", "stratum_rows")


def bootstrap_weights(df: DataFrame, key: str, replicates: int) -> DataFrame:
    """Each row once per replicate with its Poisson(1) ``weight``; rows drawn zero times are left out.

    Meant for replicate-wise sums, which combine map-side. For statistics of the confusion cells alone,
    ``bootstrap.cell_bootstrap`` has the same distribution at a cost that does not depend on the rows.
    """
    spread = df.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    # As a column of its own the hash is computed once, not once per comparison.
    drawn = spread.withColumn("_u", unit_hash(key, F.col("replicate")))
    return drawn.withColumn("weight", poisson_one(F.col("_u"))).drop("_u").filter(F.col("weight") > 0)
