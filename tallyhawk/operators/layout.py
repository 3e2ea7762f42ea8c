"""Physical layout: repartitioning, rows per partition, balance, size on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyhawk.functions.hashing import HASH_BITS, key_hash, salt_for

SKEW_LIMIT = 2.0


def hash_repartition(df: DataFrame, n: int, *cols: str, salt_key: str | None = None) -> DataFrame:
    """Hash-partition into ``n``. With ``salt_key``, rows of one hot value spread over all partitions.

    A column with two values fills at most two partitions; hashing the row key along with it fills all.
    """
    return df.repartition(n, *cols, *([salt_key] if salt_key else []))


def round_robin(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def capped_sample(df: DataFrame, rows: int, partitions: int, key: str) -> DataFrame:
    """The ``rows`` rows whose keys come first in hash order, spread over ``partitions``; all rows if there are fewer.

    The hash that bounds them is found by a histogram of leading bits, then one of the next bits among the rows of the bucket that the
    cap falls into, until a bucket is taken whole: about one pass for every factor of 32,768 in the rows, and no
    row moves before the filter. ``key`` identifies a row; rows that repeat a key stay or go together, within the cap.
    """
    hashed = key_hash(key, salt_for("cap"))
    bound = _hash_bound(df.select(hashed.alias("h")), rows)
    return (df if bound is None else df.filter(hashed < bound)).repartition(partitions)


def _hash_bound(hashes: DataFrame, rows: int, digit: int = 15) -> int | None:
    """The number that as many hashes as possible, ``rows`` at most, lie below; None if all do."""
    low, shift, wanted = 0, HASH_BITS, rows
    while shift > 0:
        shift -= digit
        inside = hashes.filter((F.col("h") >= low) & (F.col("h") < low + (1 << (shift + digit))))
        counts = inside.groupBy(F.shiftright(F.col("h") - low, shift).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        # at most 2^digit rows, whatever the table's size
        along = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        first = counts.withColumn("upto", F.sum("n").over(along)).filter(F.col("upto") > wanted).orderBy("bucket").first()
        if first is None:
            return None
        low += first["bucket"] << shift
        wanted -= first["upto"] - first["n"]
        if wanted == 0:
            return low
    return low


def tagged(df: DataFrame, tag: str = "partition") -> DataFrame:
    """``df`` with the number of the partition that each row is in. Write it, or cut its lineage, before counting: only then do counts speak
    of the very partitions that are used."""
    return df.withColumn(tag, F.spark_partition_id())


def tagged_rows(stored: DataFrame, partitions: int, tag: str = "partition") -> DataFrame:
    """(partition, n) of a frame stored with its tag, empty partitions included."""
    counts = stored.groupBy(tag).agg(F.count(F.lit(1)).alias("n"))
    every = stored.sparkSession.range(partitions).select(F.col("id").cast("int").alias(tag))
    return every.join(counts, tag, "left").select(tag, F.coalesce("n", F.lit(0)).alias("n"))


def partition_rows(df: DataFrame) -> DataFrame:
    """(partition, n) for the physical partitions of ``df`` as they are when this runs, empty ones included."""
    partitions = df.rdd.getNumPartitions()
    return tagged_rows(tagged(df), partitions)


def partition_balance(counts: DataFrame, n: str = "n") -> DataFrame:
    """One row: partitions, mean, population deviation, max, min, skew ratio and verdict."""
    stats = counts.agg(
        F.count(F.lit(1)).alias("n_partitions"),
        F.avg(n).alias("mean_rows"),
        F.stddev_pop(n).alias("std_rows"),
        F.max(n).alias("max_rows"),
        F.min(n).alias("min_rows"),
    )
    skew = F.col("max_rows") / F.greatest(F.col("mean_rows"), F.lit(1.0))
    verdict = F.when(F.col("skew_ratio") <= SKEW_LIMIT, "OK").otherwise("WARN: repartition recommended")
    return stats.withColumn("skew_ratio", skew).withColumn("recommendation", verdict)


def partition_outliers(counts: DataFrame, n: str = "n", deviations: float = 2.0) -> DataFrame:
    """Partitions with more rows than mean + 2 population standard deviations."""
    limit = counts.agg(F.avg(n) + deviations * F.stddev_pop(n)).scalar()
    return counts.withColumn("limit", limit).filter(F.col(n) > F.col("limit"))


def dataset_size(files: DataFrame) -> DataFrame:
    """(files, bytes) of ``readers.list_files``; files without a row count, and no row is read."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def size_ratio(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bytes of two stored forms of one table, given as listings, and their ratio."""
    first = dataset_size(a).select("bytes").scalar()
    return dataset_size(b).select(
        first.alias("bytes_a"), F.col("bytes").alias("bytes_b"), (first / F.col("bytes")).alias("ratio")
    )
