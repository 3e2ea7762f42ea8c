"""Partitioned and per-split Parquet sinks, and exports of small result tables."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.param import Params
from pyspark.ml.util import DefaultParamsReader, MLWritable
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhawk.operators.layout import hash_repartition

FILE_TASKS = 1_000
FILES_PER_TASK = 100
ROWS_PER_TASK = 1_000_000


def write_partitioned(df: DataFrame, path: str, by: str, num_files: int, salt_key: str | None = None) -> None:
    """Snappy Parquet in one folder per value of ``by``.

    Rows spread over ``num_files`` tasks by the value and a hash of ``salt_key``; without a key they
    spread by a hash of the whole row, so a value that holds nearly all rows is still written in parallel.
    """
    if salt_key is None:
        spread = df.repartition(num_files, F.xxhash64(*df.columns))
    else:
        spread = hash_repartition(df, num_files, by, salt_key=salt_key)
    spread.write.mode("overwrite").option("compression", "snappy").partitionBy(by).parquet(path)


def write_splits(df: DataFrame, path: str, columns: list[str], split: str = "split") -> None:
    """One folder per split in a single job, with exactly the listed columns; an absent one is an error."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in the table: {', '.join(absent)}")
    df.select(*columns, split).write.mode("overwrite").option("compression", "snappy").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split: str = "split") -> DataFrame:
    """One split; the filter prunes to its folder."""
    return spark.read.parquet(path).filter(F.col(split) == name).drop(split)


def export_csv(df: DataFrame, path: str, single_file: bool = True) -> None:
    """CSV with header. ``single_file`` is for small tables (metrics, thinned curves); samples go out in parallel."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def export_ordered_csv(df: DataFrame, path: str, order: list[str], rows_per_file: int = 1_000_000) -> None:
    """CSV with header whose part files hold the rows in ``order``: files by the two numbers in their names, that of the task and that of the
    file within the task (below a thousand files of one task, the order of the names).

    There are as many files as the rows ask for, each written by a task of its own. Beyond a thousand, tasks share small files: about up to a hundred
    each, none with more than ``rows_per_file`` rows. What tasks report and the sample of the range bounds, both of which go to the
    driver, follow the tasks. ``df`` is read twice, so it should be stored.
    """
    files = max(1, -(-df.count() // rows_per_file))
    each = max(1, min(FILES_PER_TASK, ROWS_PER_TASK // rows_per_file))
    tasks = max(min(files, FILE_TASKS), -(-files // each))
    spread = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    limit = {"maxRecordsPerFile": rows_per_file} if tasks < files else {}
    spread.write.mode("overwrite").options(header=True, **limit).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines of a small table or a one-row document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_result_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_result_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def load_stage(spark: SparkSession, path: str) -> Params:
    """What ``save_stage`` saved, of whatever class its metadata names."""
    return DefaultParamsReader.loadParamsInstance(path, spark)


def save_models(spark: SparkSession, models: dict[str, Model], seconds: dict[str, float], path: str) -> None:
    """Fitted models in a folder each, and an index (model, folder, train_time_s) beside them."""
    rows = []
    for name, model in models.items():
        folder = "".join(c if c.isalnum() else "_" for c in name.lower())
        save_stage(model, f"{path}/{folder}")
        rows.append((name, folder, seconds.get(name)))
    if len({folder for _, folder, _ in rows}) < len(rows):
        raise ValueError("two models would share a folder")
    export_json(spark.createDataFrame(rows, "model string, folder string, train_time_s double"), f"{path}/index")


def load_models(spark: SparkSession, path: str) -> tuple[dict[str, Model], dict[str, float]]:
    """Models by name and the seconds their fits took, from what ``save_models`` left at ``path``."""
    schema = "model string, folder string, train_time_s double"
    rows = read_result_json(spark, f"{path}/index", schema).orderBy("model").collect()
    return {r["model"]: load_stage(spark, f"{path}/{r['folder']}") for r in rows}, {r["model"]: r["train_time_s"] for r in rows}


def save_stage(stage: MLWritable, path: str) -> None:
    """Fitted model or preprocessing stage, in MLlib's own format."""
    stage.write().overwrite().save(path)
