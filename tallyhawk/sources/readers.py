"""Typed and untyped scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhawk.session import scratch_path

CORRUPT = "_corrupt_record"
LEAST_LONG = -(2**63)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_untyped_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, names from the header."""
    return spark.read.option("header", True).csv(path)


def _permissive_csv(
    spark: SparkSession, path: str, schema: T.StructType, null_value: str, nan_value: str
) -> DataFrame:
    """Every line, with the raw text of malformed ones in ``_corrupt_record``.

    The header must match the schema by name. Parsing only the selected columns would miss errors in the
    others, so a filter that no rewrite can remove keeps all of them in the scan.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    lines = (
        spark.read.schema(full)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("nullValue", null_value)
        .option("nanValue", nan_value)
        .csv(path)
    )
    return lines.filter(F.xxhash64(*schema.names) >= F.lit(LEAST_LONG))


def read_typed_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_value: str = "null",
    nan_value: str = "NaN",
    on_bad: str = "drop",
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of a CSV with a header.

    ``drop`` and ``keep`` route malformed lines to ``bad`` (their text in ``_corrupt_record``); ``keep``
    also leaves what could be parsed of them in ``good``. ``fail`` raises at the first malformed line.
    """
    if on_bad not in ("drop", "keep", "fail"):
        raise ValueError(f"on_bad must be drop, keep or fail, not {on_bad!r}")
    lines = _permissive_csv(spark, path, schema, null_value, nan_value)
    corrupt = F.col(CORRUPT)
    bad = lines.filter(corrupt.isNotNull())
    if on_bad == "drop":
        good = lines.filter(corrupt.isNull())
    elif on_bad == "keep":
        good = lines
    else:
        stop = F.raise_error(F.concat(F.lit("malformed line: "), corrupt)).cast("boolean")
        good = lines.filter(F.when(corrupt.isNull(), True).otherwise(stop))
    return good.drop(CORRUPT), bad


def ingest_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_value: str = "null",
    nan_value: str = "NaN",
    staging: str | None = None,
    key: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) after one parse: the lines are written once as Parquet, partitioned by their status.

    Use this for large inputs: counts, audits and the final write then read Parquet, not the text again.
    ``key`` adds a unique row number, fixed from here on because it is stored.
    """
    staging = staging or scratch_path(spark, "ingest")
    lines = _permissive_csv(spark, path, schema, null_value, nan_value)
    if key:
        lines = lines.withColumn(key, F.monotonically_increasing_id())
    marked = lines.withColumn("_bad", F.col(CORRUPT).isNotNull())
    marked.write.mode("overwrite").partitionBy("_bad").parquet(staging)
    full = T.StructType([*marked.schema.fields[:-1], T.StructField("_bad", T.BooleanType())])
    stored = spark.read.schema(full).parquet(staging)
    good = stored.filter(~F.col("_bad")).drop("_bad", CORRUPT)
    return good, stored.filter("_bad").drop("_bad")


def with_load_time(df: DataFrame, name: str = "ingestion_ts") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files below ``path``, partition folders included. Only the listing is read, never the contents; files of zero
    bytes are not listed."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
