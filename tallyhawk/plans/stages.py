"""The four stages end to end: ingest, features, training, evaluation.

Each stage reads what the one before wrote, so any of them can be run again alone. Paths are arguments.
"""

from __future__ import annotations

import math
import time

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhawk.operators import bootstrap, curves, layout, metrics, models, preprocessing, quality, sampling
from tallyhawk.operators.features import FeaturePlan
from tallyhawk.session import cut_lineage
from tallyhawk.sources import readers, writers

FILE_BYTES = 128 << 20
BASELINE = "Baseline"
CURVE_FILE_ROWS = 1_000_000
VECTORS = ["raw_features", "std_features", "mm_features", "pca_features"]


def ingest(
    spark: SparkSession,
    csv_path: str,
    out: str,
    schema: T.StructType,
    label: str = "Label",
    key: str = "row_id",
    num_files: int | None = None,
    rules: quality.Expectations | None = None,
    groups: dict[str, list[str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """CSV to label-partitioned Parquet under ``out``/table; returns the stored table and the rejected lines.

    Beside it stand the reports on what was stored: ``missing`` (nulls and NaNs per column), ``classes``, ``imbalance``, ``files`` (listed, with bytes),
    ``expectations`` (``rules``; by default that there are rows, the columns are there and the label is 0 or 1) and ``card``, with
    ``groups`` of columns (by default one of all doubles).

    The source has no row identifier, so each line gets a number as it is first stored. A hash of its
    content would not do: exact copies are common, and all copies would then fall in one split. Without ``num_files``
    the write has one task per 128 MB of input.
    """
    good, bad = readers.ingest_csv(spark, csv_path, schema, staging=f"{out}/staging", key=key)
    if num_files is None:
        listed = layout.dataset_size(readers.list_files(spark, csv_path)).first()["bytes"]
        num_files = max(1, math.ceil(listed / FILE_BYTES))
    writers.write_partitioned(good, f"{out}/table", by=label, num_files=num_files, salt_key=key)
    table = spark.read.parquet(f"{out}/table")
    numbers = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]
    rules = rules or quality.Expectations(required=schema.names, label=label)
    reports = {
        "missing": quality.missing_audit(table, numbers),
        "classes": quality.class_distribution(table, label),
        "imbalance": quality.imbalance_ratio(table, label),
        "expectations": quality.check_expectations(table, rules),
        "files": layout.dataset_size(readers.list_files(spark, f"{out}/table")),
    }
    for name, report in reports.items():
        writers.export_csv(report, f"{out}/{name}")
    steps = [f"parsed {csv_path}", f"rejected lines in {out}/staging", f"table by {label}"]
    card = quality.dataset_card(table, out.rstrip("/").rsplit("/", 1)[-1], label, groups or {"numbers": numbers}, "parquet", label, steps)
    writers.export_json(card, f"{out}/card")
    return table, bad


def build_features(
    table: DataFrame,
    out: str,
    plan: FeaturePlan,
    key: str,
    label: str,
    components: int | None = 20,
) -> PipelineModel:
    """Split, fit the preprocessing on the training rows, write all splits and the fitted stages."""
    spark = table.sparkSession
    parts = sampling.split_by_key(table, key)
    train = parts.filter(F.col("split") == "train")
    fitted = preprocessing.fit_preprocessing(train, plan, components)
    ready = sampling.class_weights(fitted.transform(parts), label, counted=train)
    vectors = VECTORS if components else VECTORS[:-1]
    writers.write_splits(ready, f"{out}/splits", [key, *vectors, label, "class_weight"])
    writers.save_stage(fitted, f"{out}/stages")
    stored = spark.read.parquet(f"{out}/splits")
    card = quality.feature_card(stored, plan.names, components or 0, label)
    writers.export_json(card, f"{out}/feature_card")
    return fitted


def default_estimators(label: str) -> dict[str, Estimator]:
    return {
        "Logistic Regression": models.logistic_regression(label=label),
        "Random Forest": models.random_forest(label=label),
        "GBT": models.boosted_trees(label=label),
        "Linear SVC": models.linear_svc(label=label),
    }


def train_models(
    spark: SparkSession,
    features: str,
    out: str,
    key: str,
    label: str,
    estimators: dict[str, Estimator] | None = None,
    gbt_grid: dict[str, list] | None = None,
    folds: int = 3,
) -> models.Trained:
    """Fit all models and the small-sample baseline on the training split, tune the boosted trees if given a grid, save all with their
    seconds under ``out``/models, export importances by name, and compare on val."""
    train = writers.read_split(spark, f"{features}/splits", "train")
    val = writers.read_split(spark, f"{features}/splits", "val")
    estimators = dict(estimators or default_estimators(label))
    tuned = estimators.pop("GBT") if gbt_grid and "GBT" in estimators else None
    trained = models.fit_all(train, estimators)
    if tuned is not None:
        folded = sampling.stratified_folds(train.select(key, "raw_features", label), key, label, folds)
        start = time.perf_counter()
        best, per_fold = models.tune(tuned, gbt_grid, folded, key, label)
        trained.seconds["GBT"] = time.perf_counter() - start
        trained.models["GBT"] = best
        writers.export_csv(models.fold_summary(per_fold, list(gbt_grid)), f"{out}/gbt_grid")
        writers.export_csv(per_fold, f"{out}/gbt_folds")
    baseline = models.small_sample_baseline(train, key, label)
    trained.models[BASELINE], trained.seconds[BASELINE] = baseline.models["baseline"], baseline.seconds["baseline"]
    writers.save_models(spark, trained.models, trained.seconds, f"{out}/models")
    for name, model in trained.models.items():
        if hasattr(model, "featureImportances"):
            folder = "".join(c if c.isalnum() else "_" for c in name.lower())
            writers.export_csv(models.feature_importance(model, val, top=None), f"{out}/importances/{folder}")
    scored = cut_lineage(models.score(trained.models, val, key, label))
    writers.export_csv(models.model_comparison(scored, trained.seconds), f"{out}/model_comparison")
    return trained


def evaluate(
    spark: SparkSession, features: str, out: str, key: str, label: str, trained: models.Trained | str, replicates: int = 1000,
    stability: Estimator | None = None, folds: int = 5, fractions: tuple[float, ...] = sampling.LADDER,
) -> DataFrame:
    """Score the test split once, store the scores, and derive every result table from them.

    ``trained`` is what ``train_models`` returned or, in another session, the folder it wrote to; the baseline is one of its models.
    Scores are scanned twice, for the cells in their strata and for the counts per threshold; both are stored, and all tables come from
    these. Curves are written in several files, in order. ``column_summary`` describes the places of the assembled vector on all splits, by
    feature; ``fold_stability`` (of ``stability``, if given) and ``learning_curve`` (on ``fractions``, if any) fit on the training split.
    """
    if isinstance(trained, str):
        found, _ = writers.load_models(spark, f"{trained}/models")
    else:
        found = trained.models
    test = writers.read_split(spark, f"{features}/splits", "test")
    models.score(found, test, key, label).write.mode("overwrite").parquet(f"{out}/scored")
    scored = spark.read.parquet(f"{out}/scored")
    strata = cut_lineage(bootstrap.stratum_counts(scored, key), f"{out}/strata")
    counts = cut_lineage(curves.threshold_counts(scored), f"{out}/thresholds")
    cells = cut_lineage(bootstrap.stratum_cells(strata), f"{out}/cells")
    areas = cut_lineage(curves.areas_of(counts), f"{out}/areas")
    results = models.performance_of(areas, cells)
    value = metrics.money_value(cells)
    exports = {
        "confusion": metrics.confusion_shares(cells),
        "class_report": metrics.class_report(cells),
        "bootstrap_ci": bootstrap.f1_interval(bootstrap.stratum_bootstrap(strata, replicates)),
        "money_value": value,
        "performance": results,
        "column_summary": preprocessing.described_registry(spark.read.parquet(f"{features}/splits"), "raw_features"),
    }
    train = writers.read_split(spark, f"{features}/splits", "train")
    if stability is not None:
        folded = sampling.stratified_folds(train, key, label, folds)
        exports["fold_stability"] = models.grid_search(stability, {}, folded, key, label)
    if fractions:
        val = writers.read_split(spark, f"{features}/splits", "val")
        plain = lambda: models.logistic_regression(label=label, weight_col=None, max_iter=50, standardization=True)
        exports["learning_curve"] = models.learning_curve(train, val, key, label, fractions, plain)
    for name, table in exports.items():
        writers.export_csv(table, f"{out}/{name}")
    roc = curves.with_area(curves.roc_of(counts, every=50, drop_collinear=True), areas, "auc_roc")
    pr = curves.with_area(curves.pr_of(counts, every=50), areas, "average_precision")
    for name, points in (("roc", roc), ("pr", pr)):
        writers.export_ordered_csv(cut_lineage(points), f"{out}/{name}", ["model", "place"], CURVE_FILE_ROWS)
    ranking = results.join(value.select("model", "total_value"), "model")
    ranking = metrics.rank_models(ranking, ["f1", "total_value"])
    writers.export_json(ranking, f"{out}/final_ranking")
    return ranking
