import math

import pytest
from pyspark.sql import functions as F, types as T

from tallyhawk.operators import layout
from tallyhawk.sources import readers, writers
from tallyhawk.sources.dimensions import event_dimension
from tallyhawk.sources.schema import wide_event_schema

ABC = T.StructType([T.StructField(c, T.DoubleType()) for c in "abc"])
LINES = ["a,b,c", "1,2,3", "4,5", "7,x,9", ",8,9", "null,NaN,1", "1,2,3,4"]


def write(tmp_path, lines, name="in.csv"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def flawed(tmp_path):
    return write(tmp_path, LINES)


def test_good_and_bad_lines(spark, flawed):
    good, bad = readers.read_typed_csv(spark, flawed, ABC)
    values = sorted(((r["a"] or 0.0), r["b"], r["c"]) for r in good.collect() if r["b"] and not math.isnan(r["b"]))
    assert values == [(0.0, 8.0, 9.0), (1.0, 2.0, 3.0)]
    assert sorted(r[readers.CORRUPT] for r in bad.collect()) == ["1,2,3,4", "4,5", "7,x,9"]
    nan = good.filter(F.isnan("b")).first()
    assert nan["a"] is None and nan["c"] == 1.0


def test_counts_do_not_depend_on_the_selected_columns(spark, flawed):
    good, bad = readers.read_typed_csv(spark, flawed, ABC)
    assert good.count() == bad.count() == 3
    for c in "abc":
        assert good.select(c).count() == len(good.select(c).collect()) == 3
        assert len(bad.select(c).collect()) == 3


def test_keep_and_fail(spark, flawed):
    keep, _ = readers.read_typed_csv(spark, flawed, ABC, on_bad="keep")
    assert keep.count() == 6
    fail, _ = readers.read_typed_csv(spark, flawed, ABC, on_bad="fail")
    with pytest.raises(Exception, match="malformed line"):
        fail.count()
    with pytest.raises(ValueError):
        readers.read_typed_csv(spark, flawed, ABC, on_bad="ignore")


def test_reordered_header_and_wider_file_are_not_read_silently(spark, tmp_path):
    swapped = write(tmp_path, ["b,a,c", "1,2,3"], "swapped.csv")
    with pytest.raises(Exception, match="header"):
        readers.read_typed_csv(spark, swapped, ABC)[0].collect()
    wider = write(tmp_path, ["a,b,c,d", "1,2,3,4"], "wider.csv")
    with pytest.raises(Exception, match="header"):
        readers.read_typed_csv(spark, wider, ABC)[0].collect()


def test_ingest_parses_once_and_numbers_rows(spark, tmp_path):
    path = write(tmp_path, ["a,b,c", *["1,2,3"] * 50, "4,5"])
    good, bad = readers.ingest_csv(spark, path, ABC, staging=str(tmp_path / "staging"), key="row_id")
    assert good.count() == 50 and bad.count() == 1
    assert good.select("row_id").distinct().count() == 50
    assert bad.first()[readers.CORRUPT] == "4,5"
    empty, none = readers.ingest_csv(spark, write(tmp_path, ["a,b,c", "1,2,3"], "clean.csv"), ABC, staging=str(tmp_path / "s2"))
    assert empty.count() == 1 and none.count() == 0


def test_partitioned_write_spreads_a_dominant_value(spark, tmp_path):
    df = spark.range(10_000).select("id", F.when(F.col("id") < 9_700, 0).otherwise(1).alias("label"))
    for name, salt in (("a", "id"), ("b", None)):
        path = str(tmp_path / name)
        writers.write_partitioned(df, path, "label", 8, salt_key=salt)
        stored = spark.read.parquet(path)
        assert stored.count() == 10_000 and stored.columns == ["id", "label"]
        sizes = stored.filter("label = 0").groupBy("_metadata.file_path").count().collect()
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * 9_700 / 8


def test_splits_must_have_the_declared_columns(spark, tmp_path):
    df = spark.range(10).select("id", F.lit("train").alias("split"))
    with pytest.raises(ValueError, match="pca_features"):
        writers.write_splits(df, str(tmp_path / "x"), ["id", "pca_features"])
    writers.write_splits(df, str(tmp_path / "x"), ["id"])
    assert writers.read_split(spark, str(tmp_path / "x"), "train").columns == ["id"]
    assert writers.read_split(spark, str(tmp_path / "x"), "val").count() == 0


def test_exports_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "name string, v double")
    writers.export_csv(df, str(tmp_path / "csv"))
    writers.export_json(df, str(tmp_path / "json"))
    assert sorted(readers.read_untyped_csv(spark, str(tmp_path / "csv")).collect()) == [("a", "1.5"), ("b", None)]
    for again in (
        writers.read_result_csv(spark, str(tmp_path / "csv"), "name string, v double"),
        writers.read_result_json(spark, str(tmp_path / "json"), "name string, v double"),
    ):
        assert sorted(map(tuple, again.collect())) == [("a", 1.5), ("b", None)]


def test_dataset_size_and_ratio(spark, tmp_path):
    df = spark.range(5000).select("id", F.lit("same").alias("s"))
    df.repartition(3).write.parquet(str(tmp_path / "p"))
    df.repartition(2).write.option("header", True).csv(str(tmp_path / "c"))
    spark.range(0).select("id", F.lit("same").alias("s")).write.mode("append").parquet(str(tmp_path / "p"))
    parquet, csv = readers.list_files(spark, str(tmp_path / "p")), readers.list_files(spark, str(tmp_path / "c"))
    on_disk = sum(f.stat().st_size for f in (tmp_path / "p").glob("*.parquet"))
    assert tuple(layout.dataset_size(parquet).first()) == (4, on_disk)
    assert layout.size_ratio(csv, parquet).first()["ratio"] == pytest.approx(
        sum(f.stat().st_size for f in (tmp_path / "c").glob("*.csv")) / on_disk
    )


def test_wide_schema_and_dimension(spark):
    schema = wide_event_schema()
    assert len(schema) == 81 and schema["Label"].dataType == T.IntegerType()
    assert schema.names[:2] == ["E1", "E2"] and schema.names[-1] == "E9_log"
    assert "E26_E23_ratio" in schema.names and "event_balance" in schema.names
    meta = event_dimension(spark)
    assert meta.count() == 29 and meta.select("event_code").distinct().count() == 29


def test_load_time_is_a_timestamp(spark):
    assert dict(readers.with_load_time(spark.range(1)).dtypes)["ingestion_ts"] == "timestamp"


def test_ordered_export_keeps_the_order_over_its_files(spark, tmp_path):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("a"), (F.col("id") % 5).alias("b"))
    writers.export_ordered_csv(df, str(tmp_path / "o"), ["a", "b"], rows_per_file=700)
    files = sorted((tmp_path / "o").glob("part-*.csv"))
    lines = [line for f in files for line in f.read_text().splitlines() if line != "a,b"]
    assert len(files) == 5 and [tuple(map(int, line.split(","))) for line in lines] == sorted(tuple(r) for r in df.collect())


def test_small_ordered_files_share_tasks(spark, tmp_path, monkeypatch):
    """Of many small files a task writes several, none with more rows than asked for, in order of task and turn."""
    monkeypatch.setattr(writers, "FILE_TASKS", 3)
    df = spark.range(30_000).select((F.col("id") * 7919 % 30_011).alias("a"))
    writers.export_ordered_csv(df, str(tmp_path / "o"), ["a"], rows_per_file=50)
    files = sorted((tmp_path / "o").glob("part-*.csv"))
    each = [[int(line) for line in f.read_text().splitlines() if line != "a"] for f in files]
    assert len(files) >= 600 and max(map(len, each)) <= 50
    assert len({f.name.split("-")[1] for f in files}) <= 6
    assert [x for part in each for x in part] == sorted(r["a"] for r in df.collect())
