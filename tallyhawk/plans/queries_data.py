"""Queries over sources, sinks, profiling, exploration, joins, sorts and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhawk.functions.scalars import percent
from tallyhawk.operators import explore, layout, quality, quantiles, tables
from tallyhawk.operators.quality import Expectations
from tallyhawk.plans.entities import entities
from tallyhawk.plans.registry import ENTITIES, GAPPY, below_sql, bucket_sql, hash_sql, query, rounded
from tallyhawk.functions.hashing import key_bucket
from tallyhawk.session import cached, cut_lineage, ensure_checkpoint_dir, scratch_path
from tallyhawk.sources import dimensions, readers, writers
from tallyhawk.sources.readers import read_table

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_CSV = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_tax", T.DoubleType()),
    ]
)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem")


def gappy_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with nulls and NaNs put into one column."""
    gap = (
        F.when(F.col("l_linenumber") == 3, F.lit(None))
        .when(F.col("l_linenumber") == 5, F.lit(float("nan")))
        .otherwise(F.col("l_extendedprice"))
    )
    return lineitem(spark, sf_dir).withColumn("l_extendedprice", gap)


def flawed_csv(spark: SparkSession, sf_dir: str) -> str:
    """Line items as CSV text in shared storage; each line with number 3 has a broken quantity."""
    path = scratch_path(spark, "flawed-csv")
    quantity = F.when(F.col("l_linenumber") == 3, "broken").otherwise(F.col("l_quantity").cast("string"))
    flawed = lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", quantity.alias("l_quantity"), "l_tax")
    flawed.write.option("header", True).csv(path)
    return path


# Sources and sinks


@query(
    "s1_typed_csv_good_and_bad",
    "SELECT CAST(l_linenumber AS INT) AS l_linenumber, COUNT(*) AS n, ROUND(SUM(l_quantity), 4) AS quantity, "
    "CASE WHEN l_linenumber = 3 THEN 'bad' ELSE 'good' END AS status FROM "
    "(SELECT l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS l_quantity FROM lineitem) "
    "GROUP BY l_linenumber",
)
def s1_typed_csv(spark, sf_dir):
    good, bad = readers.read_typed_csv(spark, flawed_csv(spark, sf_dir), LINE_CSV)
    both = good.withColumn("status", F.lit("good")).unionByName(
        bad.drop(readers.CORRUPT).withColumn("status", F.lit("bad"))
    )
    grouped = both.groupBy("l_linenumber", "status")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("quantity"))


@query(
    "s1_ingested_csv_counts",
    "SELECT COUNT(*) FILTER (l_linenumber <> 3) AS good_rows, COUNT(*) FILTER (l_linenumber = 3) AS bad_rows FROM lineitem",
)
def s1_ingested_csv(spark, sf_dir):
    good, bad = readers.ingest_csv(spark, flawed_csv(spark, sf_dir), LINE_CSV, key="row_id")
    return good.agg(F.count_distinct("row_id").alias("good_rows")).withColumn(
        "bad_rows", bad.agg(F.count("row_id")).scalar()
    )


@query(
    "s2_untyped_csv",
    "SELECT CASE WHEN l_linenumber = 3 THEN 'broken' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.0' END AS l_quantity, "
    "COUNT(*) AS n FROM lineitem GROUP BY 1",
)
def s2_untyped_csv(spark, sf_dir):
    raw = readers.read_untyped_csv(spark, flawed_csv(spark, sf_dir))
    return raw.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s3_parquet_scan",
    "SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS shipped, l_quantity FROM lineitem WHERE l_discount > 0.05",
)
def s3_parquet_scan(spark, sf_dir):
    rows = lineitem(spark, sf_dir).filter(F.col("l_discount") > 0.05)
    return rows.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped"), "l_quantity")


@query(
    "s4_partitioned_parquet",
    "SELECT l_returnflag, COUNT(*) AS n, ROUND(SUM(l_quantity), 4) AS quantity FROM lineitem "
    "WHERE l_returnflag <> 'R' GROUP BY l_returnflag",
)
def s4_partitioned(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    writers.write_partitioned(lineitem(spark, sf_dir), path, "l_returnflag", 8, salt_key="l_orderkey")
    stored = spark.read.parquet(path).filter(F.col("l_returnflag") != "R")
    return stored.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("quantity")
    )


@query(
    "s5_split_parquet",
    f"WITH {ENTITIES} SELECT entity_id, n_click, label FROM entities WHERE NOT {below_sql('entity_id', 'split', 0.6)} "
    f"AND {below_sql('entity_id', 'split', 0.8)}",
)
def s5_splits(spark, sf_dir):
    from tallyhawk.plans.entities import labelled_splits

    path = scratch_path(spark, "splits")
    writers.write_splits(labelled_splits(spark, sf_dir), path, ["entity_id", "n_click", "label"])
    return writers.read_split(spark, path, "val")


@query(
    "s6_cut_lineage",
    f"WITH {ENTITIES} SELECT label, COUNT(*) AS n, SUM(total_events)::BIGINT AS events FROM entities GROUP BY label",
)
def s6_cut_lineage(spark, sf_dir):
    stored = cut_lineage(entities(spark, sf_dir))
    return stored.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("total_events").alias("events"))


@query(
    "s7_reliable_checkpoint",
    f"WITH {ENTITIES} SELECT label, COUNT(*) AS n FROM entities GROUP BY label",
)
def s7_checkpoint(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    return quality.class_counts(entities(spark, sf_dir).select("entity_id", "label").checkpoint())


KIND_DIMENSION = [
    ("click", "Page clicked", "Engagement"),
    ("error", "Request failed", "Fault"),
    ("purchase", "Order placed", "Conversion"),
    ("signup", "Account created", "Conversion"),
]
KIND_SCHEMA = "event_type string, description string, category string"
KIND_SQL = (
    "kinds(event_type, description, category) AS (VALUES "
    + ", ".join(f"('{a}','{b}','{c}')" for a, b, c in KIND_DIMENSION)
    + ")"
)


@query(
    "s8_literal_dimension",
    f"WITH {KIND_SQL} SELECT category, COUNT(*) AS n FROM events JOIN kinds USING (event_type) GROUP BY category",
)
def s8_literal(spark, sf_dir):
    kinds = dimensions.literal_table(spark, KIND_DIMENSION, KIND_SCHEMA)
    joined = tables.enrich(read_table(spark, sf_dir, "events"), kinds, "event_type")
    return joined.filter(F.col("category").isNotNull()).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s9_csv_export",
    f"SELECT event_id, event_type, value FROM events WHERE {below_sql('event_id', 'sample', 0.01)}",
)
def s9_csv_export(spark, sf_dir):
    from tallyhawk.operators.sampling import bernoulli_sample

    path = scratch_path(spark, "csv-export")
    sample = bernoulli_sample(read_table(spark, sf_dir, "events"), "event_id", 0.01)
    writers.export_csv(sample.select("event_id", "event_type", "value"), path, single_file=False)
    return writers.read_result_csv(spark, path, "event_id long, event_type string, value double")


@query(
    "s10_json_document",
    f"WITH {ENTITIES} SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (label = 0) AS normal, "
    "COUNT(*) FILTER (label = 1) AS anomalous, "
    "ROUND(COUNT(*) FILTER (label = 0) / (COUNT(*) FILTER (label = 1))::DOUBLE, 2) AS imbalance_ratio FROM entities",
)
def s10_json(spark, sf_dir):
    path = scratch_path(spark, "json-export")
    writers.export_json(_entity_card(spark, sf_dir), path)
    card = writers.read_result_json(spark, path)
    classes = F.col("class_distribution")
    return card.select(
        "total_rows",
        classes["0_normal"].alias("normal"),
        classes["1_anomaly"].alias("anomalous"),
        "imbalance_ratio",
    )


@query("s11_result_reread", "SELECT l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag")
def s11_reread(spark, sf_dir):
    path = scratch_path(spark, "result")
    counts = lineitem(spark, sf_dir).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    writers.export_csv(counts, path)
    return writers.read_result_csv(spark, path, "l_returnflag string, n long")


@query(
    "s9_ordered_export",
    "SELECT o_custkey, o_orderkey, (row_number() OVER (ORDER BY o_custkey, o_orderkey)) AS place, TRUE AS many_files FROM orders",
)
def s9_ordered(spark, sf_dir):
    """Orders exported in several files at once; places follow from the names of the files and the lines in them."""
    from pyspark.sql import Window

    path = scratch_path(spark, "ordered-export")
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    writers.export_ordered_csv(orders, path, ["o_custkey", "o_orderkey"], rows_per_file=500)
    back = writers.read_result_csv(spark, path, "o_custkey long, o_orderkey long")
    name = F.col("_metadata.file_name")
    task, turn = (F.regexp_extract(name, pattern, 1).cast("long") for pattern in (r"part-(\d+)", r"-c(\d+)\."))
    back = back.select("*", (task * 1_000_000 + turn).alias("file"))
    inside = back.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("o_custkey", "o_orderkey")))
    sizes = back.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("file")) - F.col("n")).drop("n")
    files = sizes.agg(F.count(F.lit(1)) > 1).scalar()
    return inside.join(before, "file").select(
        "o_custkey", "o_orderkey", (F.col("before") + F.col("line")).alias("place"), files.alias("many_files")
    )


@query(
    "s12_dataset_size",
    "SELECT COUNT(DISTINCT l_returnflag) + 1 AS files, COUNT(DISTINCT l_returnflag) AS files_with_rows, COUNT(*) AS n_rows, TRUE AS has_bytes FROM lineitem",
)
def s12_size(spark, sf_dir):
    """One file per return flag and one without rows, all of which the listing finds."""
    path = scratch_path(spark, "sized")
    counts = lineitem(spark, sf_dir).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange(1, "l_returnflag").write.option("maxRecordsPerFile", 1).parquet(path)
    counts.limit(0).write.mode("append").parquet(path)
    rows = spark.read.parquet(path).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("files_with_rows"))
    size = layout.dataset_size(readers.list_files(spark, path))
    return rows.select(
        size.select("files").scalar().alias("files"), "files_with_rows", "n_rows", size.select(F.col("bytes") > 0).scalar().alias("has_bytes")
    )


@query("s12_size_ratio")
def s12_ratio(spark, sf_dir):
    """Bytes of the same columns as CSV and as Parquet, and their ratio."""
    csv, path = flawed_csv(spark, sf_dir), scratch_path(spark, "sized")
    readers.read_untyped_csv(spark, csv).write.parquet(path)
    return layout.size_ratio(readers.list_files(spark, csv), readers.list_files(spark, path))


# Partitioning and caching


@query("m1_hash_repartition", "SELECT COUNT(*) AS n_rows, 8::BIGINT AS filled FROM lineitem")
def m1_hash(spark, sf_dir):
    spread = layout.hash_repartition(lineitem(spark, sf_dir), 8, "l_returnflag", salt_key="l_orderkey")
    counts = layout.partition_rows(spread)
    return counts.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 0).alias("filled"))


@query("m2_round_robin", "SELECT COUNT(*) AS n_rows, 8::BIGINT AS filled FROM events")
def m2_round_robin(spark, sf_dir):
    counts = layout.partition_rows(layout.round_robin(read_table(spark, sf_dir, "events"), 8))
    return counts.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 0).alias("filled"))


@query(
    "m3_cached_passes",
    "SELECT event_type, COUNT(*) AS n, (SELECT COUNT(*) FROM events) AS of_all FROM events GROUP BY event_type",
)
def m3_cached(spark, sf_dir):
    with cached(read_table(spark, sf_dir, "events").select("event_type")) as events:
        total = events.count()
        return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("of_all", F.lit(total).cast("bigint"))


# Profiling


@query("a1_row_count", "SELECT COUNT(*) AS n_rows FROM lineitem")
def a1(spark, sf_dir):
    return quality.row_count(lineitem(spark, sf_dir))


@query(
    "a2_missing_audit",
    f"WITH {GAPPY}, long AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS nulls, "
        f"COUNT(*) FILTER (isnan({c})) AS nans FROM gappy"
        for c in LINE_NUMBERS
    )
    + ") SELECT *, CASE WHEN nulls = 0 AND nans = 0 THEN 'OK' ELSE 'WARN' END AS status FROM long",
)
def a2(spark, sf_dir):
    return quality.missing_audit(gappy_lineitem(spark, sf_dir), LINE_NUMBERS)


@query("a3_class_counts", f"WITH {ENTITIES} SELECT label, COUNT(*) AS n FROM entities GROUP BY label")
def a3(spark, sf_dir):
    return quality.class_counts(entities(spark, sf_dir))


@query(
    "a4_class_distribution",
    f"WITH {ENTITIES} SELECT label, COUNT(*) AS n, ROUND(COUNT(*)/(SELECT COUNT(*) FROM entities)::DOUBLE*100, 2) AS pct "
    "FROM entities GROUP BY label ORDER BY label",
)
def a4(spark, sf_dir):
    return quality.class_distribution(entities(spark, sf_dir))


@query(
    "a4_imbalance_ratio",
    f"WITH {ENTITIES}, c AS (SELECT COUNT(*) FILTER (label=0) AS n0, COUNT(*) FILTER (label=1) AS n1 FROM entities) "
    "SELECT n0, n1, ROUND(n0/greatest(n1,1)::DOUBLE, 6) AS ratio FROM c",
)
def a4_ratio(spark, sf_dir):
    return rounded(quality.imbalance_ratio(entities(spark, sf_dir)))


@query(
    "a5_column_summary",
    f"WITH {GAPPY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(v) AS n, COUNT(*) FILTER ({c} IS NULL) AS nulls, "
        f"COUNT(*) FILTER (isnan({c})) AS nans, ROUND(AVG(v),4) AS mean, ROUND(STDDEV_SAMP(v),4) AS stddev, "
        f"ROUND(MIN(v),4) AS min, ROUND(MAX(v),4) AS max "
        f"FROM (SELECT {c}, CASE WHEN NOT isnan({c}) THEN {c} END AS v FROM gappy)"
        for c in LINE_NUMBERS
    ),
)
def a5(spark, sf_dir):
    return rounded(quality.column_summary(gappy_lineitem(spark, sf_dir), LINE_NUMBERS), 4)


@query(
    "a6_group_mean",
    f"WITH {ENTITIES} SELECT label, COUNT(*) AS n, ROUND(AVG(total_events), 6) AS mean_total_events FROM entities GROUP BY label",
)
def a6(spark, sf_dir):
    return rounded(explore.group_mean(entities(spark, sf_dir), "label", "total_events"))


@query("a7_distinct_values", "SELECT DISTINCT event_type FROM events")
def a7(spark, sf_dir):
    return quality.distinct_values(read_table(spark, sf_dir, "events"), "event_type")


@query(
    "a7_domain_check",
    "SELECT COUNT(*) FILTER (l_returnflag NOT IN ('A','N')) AS outside, "
    "COUNT(*) FILTER (l_returnflag NOT IN ('A','N')) = 0 AS ok FROM lineitem",
)
def a7_domain(spark, sf_dir):
    return quality.domain_check(lineitem(spark, sf_dir), "l_returnflag", ["A", "N"])


def _correlation_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, ROUND(CORR({x}, {y}), 6) AS r FROM lineitem"
        for x in LINE_NUMBERS
        for y in LINE_NUMBERS
    )


@query("a8_correlations", _correlation_sql())
def a8(spark, sf_dir):
    return rounded(explore.correlations(lineitem(spark, sf_dir), LINE_NUMBERS))


@query(
    "a9_histogram",
    "WITH e AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem), "
    "c AS (SELECT least(floor((l_extendedprice-lo)/(hi-lo)*50), 49)::BIGINT AS bin, COUNT(*) AS n FROM lineitem, e GROUP BY 1) "
    "SELECT b.bin, ROUND(lo+(hi-lo)*b.bin/50,4) AS lower, ROUND(lo+(hi-lo)*(b.bin+1)/50,4) AS upper, "
    "COALESCE(c.n,0)::BIGINT AS n FROM (SELECT UNNEST(range(50))::BIGINT AS bin) b LEFT JOIN c ON b.bin=c.bin, e",
)
def a9(spark, sf_dir):
    return rounded(explore.histogram(lineitem(spark, sf_dir), "l_extendedprice"), 4)


@query(
    "a10_class_counts_on_sample",
    f"WITH {ENTITIES} SELECT label, COUNT(*) AS n FROM entities WHERE {below_sql('entity_id', 'sample', 0.1)} GROUP BY label",
)
def a10(spark, sf_dir):
    from tallyhawk.operators.sampling import bernoulli_sample

    return quality.class_counts(bernoulli_sample(entities(spark, sf_dir), "entity_id", 0.1))


def _box_sql() -> str:
    parts = []
    for c in LINE_NUMBERS:
        parts.append(
            f"SELECT l_returnflag, '{c}' AS feature, COUNT(*) AS n, ROUND(ANY_VALUE(q1),4) AS q1, "
            f"ROUND(ANY_VALUE(q2),4) AS median, ROUND(ANY_VALUE(q3),4) AS q3, "
            f"ROUND(MIN({c}) FILTER ({c} BETWEEN lo AND hi),4) AS whisker_low, "
            f"ROUND(MAX({c}) FILTER ({c} BETWEEN lo AND hi),4) AS whisker_high, "
            f"COUNT(*) FILTER (NOT ({c} BETWEEN lo AND hi)) AS outliers "
            f"FROM (SELECT *, q1-1.5*(q3-q1) AS lo, q3+1.5*(q3-q1) AS hi FROM lineitem JOIN "
            f"(SELECT l_returnflag, quantile_cont({c},0.25) AS q1, quantile_cont({c},0.5) AS q2, "
            f"quantile_cont({c},0.75) AS q3 FROM lineitem GROUP BY 1) USING (l_returnflag)) GROUP BY 1"
        )
    return " UNION ALL ".join(parts)


@query("a11_box_statistics", _box_sql())
def a11(spark, sf_dir):
    return rounded(quantiles.box_statistics(lineitem(spark, sf_dir), LINE_NUMBERS, ["l_returnflag"]), 4)


@query(
    "a12_medians",
    f"WITH {GAPPY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, 0.5::DOUBLE AS p, ROUND(quantile_disc({c},0.5) FILTER (NOT isnan({c})),4) AS q FROM gappy"
        for c in LINE_NUMBERS
    ),
)
def a12(spark, sf_dir):
    found = quantiles.exact_quantiles(gappy_lineitem(spark, sf_dir), LINE_NUMBERS, [0.5], method="lower")
    return rounded(found, 4)


@query(
    "a13_partition_rows",
    "SELECT COUNT(*) AS n_rows, 16::BIGINT AS partitions, COUNT(DISTINCT l_orderkey) AS orders, 0::BIGINT AS split_orders, 0::BIGINT AS elsewhere FROM lineitem",
)
def a13(spark, sf_dir):
    """Rows per partition of a stored frame that carries its partition numbers: every file holds one number's rows, and no order lies in two."""
    spread = layout.tagged(layout.hash_repartition(lineitem(spark, sf_dir).select("l_orderkey"), 16, "l_orderkey"))
    stored = cut_lineage(spread)
    counts = layout.tagged_rows(stored, 16)
    orders = stored.groupBy("l_orderkey").agg(F.count_distinct("partition").alias("places"))
    files = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("partition").alias("low"), F.max("partition").alias("high"))
    return counts.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("partitions")).select(
        "n_rows", "partitions", orders.agg(F.count(F.lit(1))).scalar().alias("orders"),
        orders.agg(F.count_if(F.col("places") > 1)).scalar().alias("split_orders"),
        files.agg(F.count_if(F.col("low") != F.col("high"))).scalar().alias("elsewhere"),
    )


BUCKET_LOADS = f"loads AS (SELECT {bucket_sql('user_id', 64)} AS bucket, COUNT(*) AS n FROM events GROUP BY 1)"


def bucket_loads(spark, sf_dir):
    bucket = key_bucket("user_id", 64).alias("bucket")
    return read_table(spark, sf_dir, "events").groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a14_partition_balance",
    f"WITH {BUCKET_LOADS}, s AS (SELECT COUNT(*) AS n_partitions, AVG(n) AS mean_rows, STDDEV_POP(n) AS std_rows, "
    "MAX(n) AS max_rows, MIN(n) AS min_rows FROM loads) SELECT n_partitions, ROUND(mean_rows,6) AS mean_rows, "
    "ROUND(std_rows,6) AS std_rows, max_rows, min_rows, ROUND(max_rows/greatest(mean_rows,1),6) AS skew_ratio, "
    "CASE WHEN max_rows/greatest(mean_rows,1) <= 2 THEN 'OK' ELSE 'WARN: repartition recommended' END AS recommendation FROM s",
)
def a14(spark, sf_dir):
    return rounded(layout.partition_balance(bucket_loads(spark, sf_dir)))


@query(
    "a15_partition_outliers",
    f"WITH {BUCKET_LOADS}, l AS (SELECT AVG(n)+2*STDDEV_POP(n) AS lim FROM loads) "
    "SELECT bucket, n, ROUND(lim,6) AS \"limit\" FROM loads, l WHERE n > lim",
)
def a15(spark, sf_dir):
    return rounded(layout.partition_outliers(bucket_loads(spark, sf_dir)))


def _entity_card(spark, sf_dir):
    return quality.dataset_card(
        entities(spark, sf_dir),
        "entities",
        "label",
        {"counts": ["n_click", "n_error", "n_purchase", "n_signup", "n_view"], "values": ["sum_value"]},
        "Parquet/Snappy",
        "label",
        ["events scanned", "grouped per user and day", "labelled by value"],
    )


@query(
    "a16_dataset_card",
    f"WITH {ENTITIES} SELECT 'entities' AS dataset, COUNT(*) AS total_rows, 5::INT AS num_features, 'label' AS target_column, "
    "COUNT(*) FILTER (label=0) AS n0, COUNT(*) FILTER (label=1) AS n1, "
    "ROUND(COUNT(*) FILTER (label=0)/(COUNT(*) FILTER (label=1))::DOUBLE,2) AS imbalance_ratio, "
    "'Parquet/Snappy' AS storage_format, 'label' AS partition_column FROM entities",
)
def a16(spark, sf_dir):
    classes = F.col("class_distribution")
    return _entity_card(spark, sf_dir).select(
        "dataset",
        "total_rows",
        "num_features",
        "target_column",
        classes["0_normal"].alias("n0"),
        classes["1_anomaly"].alias("n1"),
        "imbalance_ratio",
        "storage_format",
        "partition_column",
    )


@query(
    "a17_feature_card",
    f"WITH {ENTITIES}, s AS (SELECT label, {below_sql('entity_id', 'split', 0.6)} AS train, {below_sql('entity_id', 'split', 0.8)} AS early FROM entities), "
    "c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (label=0) AS n0, COUNT(*) FILTER (label=1) AS n1, "
    "COUNT(*) FILTER (train) AS train, COUNT(*) FILTER (NOT train AND early) AS val, COUNT(*) FILTER (NOT early) AS test FROM s) "
    "SELECT 6::INT AS n_features, 3::INT AS pca_components, ROUND(n/(2.0*n0),6) AS w0, ROUND(n/(2.0*n1),6) AS w1, "
    "train, val, test FROM c",
)
def a17(spark, sf_dir):
    from tallyhawk.plans.entities import COUNTS, labelled_splits

    card = quality.feature_card(labelled_splits(spark, sf_dir), [*COUNTS, "sum_value"], 3)
    weights = F.col("class_weights")
    flat = card.select("n_features", "pca_components", weights["0"].alias("w0"), weights["1"].alias("w1"), "splits.*")
    return rounded(flat)


@query(
    "a18_best_row",
    f"WITH {ENTITIES} SELECT entity_id, sum_value, label FROM entities ORDER BY sum_value DESC, entity_id LIMIT 1",
)
def a18(spark, sf_dir):
    return tables.best_row(entities(spark, sf_dir).select("entity_id", "sum_value", "label"), "sum_value", "entity_id")


RULES = Expectations(
    min_rows=100,
    required=["l_orderkey", "l_weight"],
    not_null=["l_quantity", "l_extendedprice"],
    label="l_linenumber",
    label_domain=(1, 2, 3),
)


@query(
    "a21_expectations",
    f"WITH {GAPPY}, c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (l_quantity IS NULL) AS q, "
    "COUNT(*) FILTER (l_extendedprice IS NULL OR isnan(l_extendedprice)) AS p, "
    "COUNT(*) FILTER (l_linenumber NOT IN (1,2,3)) AS o FROM gappy) "
    "SELECT 'rows >= 100' AS rule, n AS observed, n >= 100 AS passed FROM c "
    "UNION ALL SELECT 'column l_orderkey present', 1, TRUE FROM c "
    "UNION ALL SELECT 'column l_weight present', 0, FALSE FROM c "
    "UNION ALL SELECT 'l_quantity has no nulls', q, q=0 FROM c "
    "UNION ALL SELECT 'l_extendedprice has no nulls', p, p=0 FROM c "
    "UNION ALL SELECT 'l_linenumber in {1, 2, 3}', o, o=0 FROM c",
)
def a21(spark, sf_dir):
    return quality.check_expectations(gappy_lineitem(spark, sf_dir), RULES)


@query(
    "a21_group_coverage",
    "SELECT event_type, COUNT(*) AS n, CASE event_type WHEN 'click' THEN 'cat_engage' WHEN 'view' THEN 'cat_engage' "
    "WHEN 'purchase' THEN 'cat_convert' WHEN 'error' THEN 'cat_error' END AS feature_group, "
    "event_type <> 'signup' AS mapped FROM events GROUP BY event_type",
)
def a21_coverage(spark, sf_dir):
    kinds = read_table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    groups = {"cat_engage": ["click", "view"], "cat_convert": ["purchase"], "cat_error": ["error"]}
    return quality.coverage_check(spark, kinds, "event_type", groups)


# Projections, filters, joins, sorts, set operations


@query("p1_project", "SELECT event_id, user_id, value FROM events")
def p1(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("event_id", "user_id", "value")


@query("p2_load_time", "SELECT event_id, TRUE AS loaded FROM events")
def p2(spark, sf_dir):
    loaded = readers.with_load_time(read_table(spark, sf_dir, "events"))
    return loaded.select("event_id", (F.col("ingestion_ts") <= F.current_timestamp()).alias("loaded"))


@query("p8_class_filter", f"WITH {ENTITIES} SELECT entity_id, total_events, sum_value FROM entities WHERE label = 1")
def p8(spark, sf_dir):
    return entities(spark, sf_dir).filter(F.col("label") == 1).select("entity_id", "total_events", "sum_value")


@query("p9_interval_filter", "SELECT event_id, value FROM events WHERE value >= 20 AND value < 60")
def p9(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return events.filter((F.col("value") >= 20) & (F.col("value") < 60)).select("event_id", "value")


@query(
    "p10_share_of_total",
    "SELECT event_type, COUNT(*) AS n, ROUND(COUNT(*)/(SELECT COUNT(*) FROM events)::DOUBLE*100, 2) AS pct "
    "FROM events GROUP BY event_type",
)
def p10(spark, sf_dir):
    counts = read_table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), counts.agg(F.sum("n")).scalar()))


@query(
    "p11_literal_key",
    f"WITH {KIND_SQL}, {ENTITIES} SELECT entity_id, n_click, 'click' AS event_type, 'Engagement' AS category FROM entities",
)
def p11(spark, sf_dir):
    kinds = dimensions.literal_table(spark, KIND_DIMENSION, KIND_SCHEMA)
    base = entities(spark, sf_dir).select("entity_id", "n_click")
    return tables.enrich_constant(base, kinds, "event_type", "click").drop("description")


@query(
    "p17_typed_by_built_schema",
    f"WITH {ENTITIES} SELECT COUNT(*) AS n, SUM(n_click)::DOUBLE AS clicks, SUM(label)::BIGINT AS positives FROM entities",
)
def p17(spark, sf_dir):
    from tallyhawk.plans.entities import COUNTS
    from tallyhawk.sources.schema import table_schema

    path = scratch_path(spark, "schema")
    entities(spark, sf_dir).select(*COUNTS, "label", "sum_value").write.option("header", True).csv(path)
    good, _ = readers.read_typed_csv(spark, path, table_schema(COUNTS, "label", ["sum_value"]))
    return good.agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_click").alias("clicks"), F.sum("label").alias("positives")
    )


@query(
    "j1_enrich_events",
    f"WITH {KIND_SQL} SELECT event_id, value, description, category FROM events LEFT JOIN kinds USING (event_type)",
)
def j1(spark, sf_dir):
    kinds = dimensions.literal_table(spark, KIND_DIMENSION, KIND_SCHEMA)
    events = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return tables.enrich(events, kinds, "event_type").select("event_id", "value", "description", "category")


@query(
    "j1_enrich_customers",
    "SELECT c_custkey, c_acctbal, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def j1_customers(spark, sf_dir):
    nation = read_table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return tables.enrich(customer, nation, "c_nationkey").select("c_custkey", "c_acctbal", "n_name")


@query(
    "t1_sorted_result",
    "SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY o_orderpriority ORDER BY o_orderpriority",
)
def t1(spark, sf_dir):
    counts = read_table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("o_orderpriority")


@query(
    "t2_top_1000",
    "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 1000",
)
def t2(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return explore.top_rows(events, [F.desc("value"), F.asc("event_id")], 1000)


@query(
    "t3_capped_sample",
    f"SELECT event_id, event_type FROM events QUALIFY row_number() OVER (ORDER BY {hash_sql('event_id', 'cap')}) <= 500",
)
def t3(spark, sf_dir):
    return layout.capped_sample(read_table(spark, sf_dir, "events").select("event_id", "event_type"), 500, 4, "event_id")


@query("t4_head", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 5")
def t4(spark, sf_dir):
    return explore.top_rows(read_table(spark, sf_dir, "events").select("event_id", "value"), ["event_id"], 5)


@query(
    "u1_bag_union",
    f"WITH {ENTITIES}, u AS (SELECT entity_id, label FROM entities UNION ALL SELECT entity_id, label FROM entities WHERE label = 1) "
    "SELECT label, COUNT(*) AS n, COUNT(DISTINCT entity_id) AS distinct_ids FROM u GROUP BY label",
)
def u1(spark, sf_dir):
    base = entities(spark, sf_dir).select("entity_id", "label")
    both = tables.stack(base, base.filter(F.col("label") == 1))
    return both.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("entity_id").alias("distinct_ids")
    )


@query(
    "u2_stack_tagged",
    "SELECT c_nationkey AS nation, COUNT(*) AS n, ROUND(AVG(c_acctbal),4) AS balance, 'customer' AS side FROM customer GROUP BY 1 "
    "UNION ALL SELECT s_nationkey, COUNT(*), NULL, 'supplier' FROM supplier GROUP BY 1",
)
def u2(spark, sf_dir):
    customers = read_table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("balance")
    )
    suppliers = read_table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return rounded(tables.stack_tagged({"customer": customers, "supplier": suppliers}, "side"), 4)
