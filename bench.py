"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select data and cores.
``queries`` holds the better of two runs in seconds; the learning curve and the four fits are run once. ``at_baseline_scale`` repeats the entity table to the
Set BENCH_TREES=1 to include the forest and one boosted-trees fit there, which take minutes, or
BENCH_BASELINE_SCALE=0 to leave that part out.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, functions as F

from tallyhawk.operators import bootstrap, curves, metrics, models, sampling
from tallyhawk.plans import queries_models
from tallyhawk.plans.catalog import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TRAIN_ROWS = 2_071_469
TEST_ROWS = 689_195

HEADLINE = [
    "a2_missing_audit",
    "a4_class_distribution",
    "a5_column_summary",
    "a8_correlations",
    "a9_histogram",
    "a11_box_statistics",
    "a12_medians",
    "j1_enrich_events",
    "t2_top_1000",
    "p14_all_features",
    "m7_three_way_split",
    "m9_oversampled",
    "m10_class_weights",
    "m11_stratified_folds",
    "m12_bootstrap_cells",
    "e1_confusion",
    "e2_areas",
    "w4_thinned_roc",
    "e6_pr_thinned",
    "e7_bootstrap_interval",
    "e8_money_value",
    "s1_ingested_csv_counts",
    "s4_partitioned_parquet",
    "l8_batch_scores",
    "l10_learning_curve",
    "e11_final_ranking",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def repeated(df, rows: int):
    """The rows of ``df`` over and over until there are exactly ``rows`` of them, spread over all cores."""
    n = df.count()
    copies = F.when(F.col("_i") <= rows % n, rows // n + 1).otherwise(rows // n)
    numbered = df.withColumn("_i", F.row_number().over(_by_key()))
    many = numbered.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    return many.drop("_i").repartition(2 * int(CPUS))


def _by_key():
    from pyspark.sql import Window

    return Window.orderBy("entity_id")  # a bench fixture of a few thousand rows


def at_baseline_scale(spark) -> dict[str, float]:
    ready = queries_models.prepared(spark, SF_DIR)
    columns = ["entity_id", "label", "class_weight", "std_features", "raw_features"]
    train = repeated(ready.part("train").select(*columns), TRAIN_ROWS).persist()
    test = repeated(ready.part("test").select(*columns), TEST_ROWS).persist()
    train.count(), test.count()
    out: dict[str, float] = {}
    fitted = {}
    fits = {
        "logistic_regression": models.logistic_regression(),
        "linear_svc": models.linear_svc(),
    }
    if os.environ.get("BENCH_TREES"):
        fits["random_forest"] = models.random_forest()
        fits["boosted_trees_one_fit"] = models.boosted_trees(depth=6, step=0.2)
    for name, estimator in fits.items():
        trained = models.fit_all(train.select("label", "class_weight", "std_features", "raw_features"), {name: estimator})
        out[name], fitted[name] = trained.seconds[name], trained.models[name]
    scored = models.score(fitted, test, "entity_id").persist()
    out["score"] = seconds(scored.count)
    out["areas_and_curves"] = seconds(lambda: drain(curves.roc_points(scored, every=50, drop_collinear=True)))
    cells = metrics.confusion(scored)
    out["bootstrap_1000"] = seconds(lambda: drain(bootstrap.f1_interval(bootstrap.cell_bootstrap(cells, 1000))))
    curve = models.learning_curve(train, test, "entity_id", fractions=(1.0,))
    out["learning_curve_full_fraction"] = curve.first()["time_s"]
    out["stratified_folds"] = seconds(
        lambda: drain(sampling.stratified_folds(train.select("entity_id", "label"), "entity_id", "label", 3))
    )
    for df in (train, test, scored):
        df.unpersist()
    return out


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    queries_models.prepared(spark, SF_DIR)
    timings["fit_four_models"] = round(seconds(lambda: queries_models.trained(spark, SF_DIR)), 3)
    for name in HEADLINE:
        runs = 1 if name == "l10_learning_curve" else 2
        timings[name] = round(min(seconds(lambda: drain(QUERIES[name](spark, SF_DIR))) for _ in range(runs)), 3)
    wanted = os.environ.get("BENCH_BASELINE_SCALE", "1") != "0"
    scale = {k: round(v, 3) for k, v in at_baseline_scale(spark).items()} if wanted else {}
    record = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "at_baseline_scale": {"train_rows": TRAIN_ROWS, "test_rows": TEST_ROWS, "seconds": scale},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }
    print(json.dumps(record))


if __name__ == "__main__":
    main()
