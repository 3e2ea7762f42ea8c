"""Distributed classifiers with published settings as defaults, batch scoring, importances, learning curves."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tallyhawk.functions.scalars import positive_score
from tallyhawk.operators.curves import curve_areas
from tallyhawk.operators.metrics import confusion, weighted_metrics
from tallyhawk.operators.preprocessing import feature_registry
from tallyhawk.operators.sampling import LADDER, bernoulli_sample, class_weights, stratified_sample
from tallyhawk.session import cached, cut_lineage, ensure_checkpoint_dir


def logistic_regression(
    features: str = "std_features",
    label: str = "label",
    weight_col: str | None = "class_weight",
    max_iter: int = 100,
    reg_param: float = 0.01,
    standardization: bool = False,
    **params,
) -> LogisticRegression:
    weights = {"weightCol": weight_col} if weight_col else {}
    return LogisticRegression(
        featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg_param,
        elasticNetParam=0.0, standardization=standardization, **weights, **params,
    )


def random_forest(
    features: str = "raw_features",
    label: str = "label",
    weight_col: str | None = None,
    trees: int = 100,
    depth: int = 10,
    bins: int = 32,
    subsample: float = 0.8,
    seed: int = 42,
    cache_node_ids: bool = True,
    **params,
) -> RandomForestClassifier:
    """``cache_node_ids`` keeps where each row stands in each tree from level to level, where else every pass over the rows
    descends all trees from their roots; the trees are the same. It wants a checkpoint directory, see ``ensure_checkpoint_dir``."""
    weights = {"weightCol": weight_col} if weight_col else {}
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth, maxBins=bins,
        subsamplingRate=subsample, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=cache_node_ids, **weights, **params,
    )


def boosted_trees(
    features: str = "raw_features",
    label: str = "label",
    weight_col: str | None = None,
    iterations: int = 50,
    depth: int = 5,
    step: float = 0.1,
    subsample: float = 0.8,
    checkpoint_every: int = 10,
    seed: int = 42,
    **params,
) -> GBTClassifier:
    """The session needs a checkpoint directory, see ``ensure_checkpoint_dir``."""
    weights = {"weightCol": weight_col} if weight_col else {}
    return GBTClassifier(
        featuresCol=features, labelCol=label, maxIter=iterations, maxDepth=depth, stepSize=step,
        subsamplingRate=subsample, checkpointInterval=checkpoint_every, seed=seed, **weights, **params,
    )


def linear_svc(
    features: str = "std_features",
    label: str = "label",
    weight_col: str | None = "class_weight",
    max_iter: int = 100,
    reg_param: float = 0.01,
    **params,
) -> LinearSVC:
    weights = {"weightCol": weight_col} if weight_col else {}
    return LinearSVC(
        featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg_param, **weights, **params
    )


@dataclass
class Trained:
    """Fitted models by name and the seconds each fit took."""

    models: dict[str, Model] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def fit_all(train: DataFrame, estimators: dict[str, Estimator], cache: bool = False) -> Trained:
    """Fit each estimator on the same training rows and time it.

    Solvers keep their own blocks of the rows they read, so stored splits are best left uncached here;
    ``cache`` is for training rows that are costly to derive.
    """
    ensure_checkpoint_dir(train.sparkSession)
    out = Trained()
    used = {e.getOrDefault(p) for e in estimators.values() for p in (e.featuresCol, e.labelCol)}
    used |= {e.getOrDefault(e.weightCol) for e in estimators.values() if e.isDefined(e.weightCol)}
    rows = train.select(*sorted(used))
    with cached(rows) if cache else nullcontext():
        for name, estimator in estimators.items():
            start = time.perf_counter()
            out.models[name] = estimator.fit(rows)
            out.seconds[name] = time.perf_counter() - start
    return out


def score(models: dict[str, Model], df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """(model, key, label, score, prediction) of all models, from one scan of ``df``.

    Models are chained over the same rows with their own output columns and unpivoted at the end, where
    one union branch per model would read and prepare the rows once for each.
    """
    wide, records = df, []
    for i, (name, model) in enumerate(models.items()):
        columns = {"predictionCol": f"_p{i}", "rawPredictionCol": f"_r{i}"}
        if model.hasParam("probabilityCol"):
            columns["probabilityCol"] = f"_q{i}"
        model = model.copy({model.getParam(p): c for p, c in columns.items()})
        wide = model.transform(wide)
        records.append(
            F.struct(
                F.lit(name).alias("model"),
                positive_score(wide, f"_q{i}", f"_r{i}").alias("score"),
                F.col(f"_p{i}").cast("int").alias("prediction"),
            )
        )
    long = wide.select(key, F.col(label).alias("label"), F.explode(F.array(*records)).alias("_m"))
    return long.select("_m.model", key, "label", "_m.score", "_m.prediction")


def performance(scored: DataFrame) -> DataFrame:
    """(model, auc_roc, f1, accuracy, precision, recall). One row per model on both sides of the join."""
    return performance_of(curve_areas(scored), confusion(scored))


def performance_of(areas: DataFrame, cells: DataFrame) -> DataFrame:
    """The same from areas and confusion cells that are there already."""
    return areas.select("model", "auc_roc").join(weighted_metrics(cells), "model")


def model_comparison(scored: DataFrame, seconds: dict[str, float]) -> DataFrame:
    """Performance with training seconds."""
    log = scored.sparkSession.createDataFrame(list(seconds.items()), "model string, train_time_s double")
    return performance(scored).join(log, "model", "left").select("model", "auc_roc", "f1", "accuracy", "train_time_s")


def feature_importance(model: Model, df: DataFrame, vector: str = "raw_features", top: int | None = 20) -> DataFrame:
    """(feature, importance), highest first. As many rows as the vector is wide."""
    registry = feature_registry(df, vector)
    one = df.sparkSession.createDataFrame([(model.featureImportances,)], ["importances"])
    long = one.select(F.posexplode(vector_to_array("importances")).alias("idx", "importance"))
    ordered = long.join(registry, "idx").select("feature", "importance").orderBy(F.desc("importance"), "feature")
    return ordered.limit(top) if top else ordered


def grid_search(
    estimator: Estimator,
    grid: dict[str, list],
    folded: DataFrame,
    key: str,
    label: str = "label",
    fold: str = "fold",
    parallelism: int = 2,
) -> DataFrame:
    """(params..., fold, auc): every grid cell fitted on all folds but one and scored on that one.

    ``folded`` carries an integer fold column and is stored first: a fit is hundreds of jobs, and no task of theirs
    then carries how folds are found. An empty grid gives one row per fold. Fits run ``parallelism`` at a time, each begun
    as another ends. The result is one row per fit.
    """
    spark = folded.sparkSession
    ensure_checkpoint_dir(spark)
    names = list(grid)
    cells = [dict(zip(names, values)) for values in product(*grid.values())]
    every = cut_lineage(folded)
    folds = [row[0] for row in every.select(fold).distinct().orderBy(fold).collect()]

    def run(task: tuple[int, dict]) -> tuple:
        held_out, cell = task
        train, test = every.filter(F.col(fold) != held_out), every.filter(F.col(fold) == held_out)
        model = estimator.copy({estimator.getParam(n): v for n, v in cell.items()}).fit(train)
        auc = curve_areas(score({"cell": model}, test, key, label)).first()
        return (*cell.values(), held_out, auc["auc_roc"] if auc else None)

    tasks = list(product(folds, cells))
    pool = ThreadPool(min(parallelism, len(tasks)))
    try:
        rows = pool.map(inheritable_thread_target(spark)(run), tasks, chunksize=1)
    finally:
        pool.close()
    kinds = {int: "int", float: "double", str: "string", bool: "boolean"}
    typed = [f"`{n}` {kinds[type(grid[n][0])]}" for n in names]
    return spark.createDataFrame(rows, ", ".join([*typed, "fold int", "auc double"]))


def fold_summary(results: DataFrame, by: list[str]) -> DataFrame:
    """(params..., mean_auc, std_auc, folds): mean and population deviation over folds."""
    grouped = results.groupBy(*by) if by else results.groupBy()
    return grouped.agg(
        F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"), F.count("auc").alias("folds")
    )


def tune(
    estimator: Estimator, grid: dict[str, list], folded: DataFrame, key: str, label: str = "label", parallelism: int = 2
) -> tuple[Model, DataFrame]:
    """(best model refitted on all folds, per-fold results). Give it training rows only."""
    results = grid_search(estimator, grid, folded, key, label, parallelism=parallelism)
    names = list(grid)
    best = fold_summary(results, names).orderBy(F.desc("mean_auc"), *names).first()
    chosen = estimator.copy({estimator.getParam(n): best[n] for n in names})
    return chosen.fit(folded), results


def small_sample_baseline(
    train: DataFrame, key: str, label: str = "label", fraction: float = 0.02, max_iter: int = 500
) -> Trained:
    """Weighted logistic regression on a stratified sample, with the weights of that sample."""
    sample = stratified_sample(train.drop("class_weight"), key, label, fraction)
    weighted = class_weights(sample, label)
    return fit_all(weighted, {"baseline": logistic_regression(label=label, max_iter=max_iter)}, cache=True)


def learning_curve(
    train: DataFrame,
    val: DataFrame,
    key: str,
    label: str = "label",
    fractions: tuple[float, ...] = LADDER,
    make: Callable[[], Estimator] | None = None,
) -> DataFrame:
    """(frac, n_rows, train_f1, val_f1, time_s) of an unweighted model on nested key-hash samples.

    Give it stored rows: they are read again for each fraction.
    """
    spark = train.sparkSession
    make = make or (lambda: logistic_regression(label=label, weight_col=None, max_iter=50, standardization=True))
    rows = []
    for frac in fractions:
        start = time.perf_counter()
        part = bernoulli_sample(train, key, frac)
        model = make().fit(part)
        both = score({"train": model}, part, key, label).unionByName(score({"val": model}, val, key, label))
        cells = confusion(both)
        total = sum((F.col(c) for c in ("fp", "fn", "tn")), F.col("tp"))
        found = {
            r["model"]: r
            for r in weighted_metrics(cells.withColumn("n", total), ["model", "n"]).collect()
        }
        spent = time.perf_counter() - start
        rows.append((frac, found["train"]["n"], found["train"]["f1"], found["val"]["f1"], spent))
    return spark.createDataFrame(rows, "frac double, n_rows long, train_f1 double, val_f1 double, time_s double")
