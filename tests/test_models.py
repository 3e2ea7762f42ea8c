import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyhawk.operators import models, preprocessing, sampling
from tallyhawk.operators.curves import curve_areas
from tallyhawk.operators.features import FeaturePlan, wide_event_plan
from tallyhawk.plans import stages
from tallyhawk.sources.readers import read_untyped_csv
from tallyhawk.sources.schema import wide_event_schema

PLAN = FeaturePlan(
    counts=["a", "b", "c"],
    groups={"cat_ab": ["a", "b"]},
    ratios={"share": ("cat_ab", "total_events")},
    logs=["cat_ab"],
    flags={"some": ("cat_ab", 0.0)},
    pairs=["a", "b"],
    powers=["c"],
)


def table(spark, n=600, seed=3):
    """Counts in which class 1 is rare and has more of ``a``; some cells are missing."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        label = int(rng.random() < 0.12)
        a = float(rng.randint(0, 4) + 3 * label)
        data.append((i, a if rng.random() > 0.05 else None, float(rng.randint(0, 5)), float(rng.randint(0, 5)), label))
    return spark.createDataFrame(data, "id long, a double, b double, c double, label int")


@pytest.fixture(scope="module")
def ready(spark):
    parts = sampling.split_by_key(table(spark), "id")
    fitted = preprocessing.fit_preprocessing(parts.filter("split = 'train'"), PLAN, components=3)
    return parts, fitted, sampling.class_weights(fitted.transform(parts)).persist()


def test_scaled_training_vectors(ready):
    _, _, df = ready
    train = df.filter("split = 'train'")
    std = train.select(F.posexplode(vector_to_array("std_features")).alias("i", "v")).groupBy("i")
    for r in std.agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s")).collect():
        assert r["m"] == pytest.approx(0, abs=1e-9) and (r["s"] == pytest.approx(1) or r["s"] == 0)
    mm = train.select(F.explode(vector_to_array("mm_features")).alias("v")).agg(F.min("v"), F.max("v")).first()
    assert tuple(mm) == (0.0, 1.0)


def test_nothing_leaks_from_other_splits(spark, ready):
    parts, fitted, _ = ready
    disturbed = parts.withColumn("a", F.when(F.col("split") == "train", F.col("a")).otherwise(F.lit(1e6)))
    again = preprocessing.fit_preprocessing(disturbed.filter("split = 'train'"), PLAN, components=3)
    assert again.stages[0].getOrDefault("medians") == fitted.stages[0].getOrDefault("medians")
    assert list(again.stages[5].mean) == pytest.approx(list(fitted.stages[5].mean))


def test_registry_and_explained_variance(ready):
    _, fitted, df = ready
    assert [r["feature"] for r in preprocessing.feature_registry(df, "raw_features").orderBy("idx").collect()] == PLAN.names
    variance = preprocessing.explained_variance(fitted, df).orderBy("component").collect()
    assert len(variance) == 3 and variance[0]["within"]
    assert all(x["cumulative"] <= y["cumulative"] <= 1 + 1e-9 for x, y in zip(variance, variance[1:]))


def test_preprocessing_reloads_to_the_same_vectors(ready, tmp_path):
    parts, fitted, df = ready
    fitted.write().overwrite().save(str(tmp_path / "stages"))
    again = PipelineModel.load(str(tmp_path / "stages")).transform(parts)
    before = {r["id"]: r["pca_features"] for r in df.select("id", "pca_features").collect()}
    assert {r["id"]: r["pca_features"] for r in again.select("id", "pca_features").collect()} == before


@pytest.fixture(scope="module")
def trained(ready):
    estimators = {
        "lr": models.logistic_regression(max_iter=30),
        "rf": models.random_forest(trees=10, depth=4),
        "gbt": models.boosted_trees(iterations=5, depth=3, weight_col="class_weight"),
        "svc": models.linear_svc(max_iter=30),
    }
    return models.fit_all(ready[2].filter("split = 'train'"), estimators)


def test_every_model_learns(ready, trained):
    test = ready[2].filter("split = 'test'")
    scored = models.score(trained.models, test, "id").persist()
    assert scored.count() == 4 * test.count()
    assert set(trained.seconds) == {"lr", "rf", "gbt", "svc"}
    for r in models.performance(scored).collect():
        assert r["auc_roc"] > 0.8, r
        assert all(0 <= r[c] <= 1 for c in ("f1", "accuracy", "precision", "recall"))
    assert models.model_comparison(scored, trained.seconds).filter("train_time_s > 0").count() == 4


def test_chained_scores_equal_single_scores(ready, trained):
    test = ready[2].filter("split = 'test'")
    chained = {(r["model"], r["id"]): (r["score"], r["prediction"]) for r in models.score(trained.models, test, "id").collect()}
    for name, model in trained.models.items():
        column = "probability" if "probability" in model.transform(test).columns else "rawPrediction"
        for r in model.transform(test).select("id", vector_to_array(column)[1].alias("s"), "prediction").collect():
            assert chained[name, r["id"]] == (r["s"], int(r["prediction"]))


def test_model_reloads_to_the_same_predictions(ready, trained, tmp_path):
    trained.models["lr"].write().overwrite().save(str(tmp_path / "lr"))
    again = LogisticRegressionModel.load(str(tmp_path / "lr"))
    test = ready[2].filter("split = 'test'")
    assert sorted(models.score({"m": again}, test, "id").collect()) == sorted(
        models.score({"m": trained.models["lr"]}, test, "id").collect()
    )


def test_importances_are_named_and_ordered(ready, trained):
    top = models.feature_importance(trained.models["rf"], ready[2], top=5).collect()
    assert len(top) == 5 and [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)
    every = models.feature_importance(trained.models["rf"], ready[2], top=None)
    assert every.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert {r["feature"] for r in every.collect()} == set(PLAN.names)


def test_grid_search_gives_one_row_per_fit_and_tuning_picks_the_best(ready):
    train = ready[2].filter("split = 'train'").select("id", "label", "std_features", "class_weight")
    folded = sampling.stratified_folds(train, "id", "label", 3)
    grid = {"regParam": [0.01, 10.0], "maxIter": [1, 10]}
    best, results = models.tune(models.logistic_regression(), grid, folded, "id")
    assert results.count() == 12
    summary = models.fold_summary(results, list(grid)).orderBy(F.desc("mean_auc"), "regParam", "maxIter").collect()
    assert len(summary) == 4 and {r["folds"] for r in summary} == {3}
    assert (best.getRegParam(), best.getMaxIter()) == (summary[0]["regParam"], summary[0]["maxIter"])
    assert models.grid_search(models.logistic_regression(max_iter=5), {}, folded, "id").count() == 3


def test_learning_curve_and_baseline(ready):
    train, val = (ready[2].filter(F.col("split") == s).select("id", "label", "std_features") for s in ("train", "val"))
    curve = models.learning_curve(train, val, "id", fractions=(0.3, 1.0)).orderBy("frac").collect()
    n = train.count()
    assert curve[1]["n_rows"] == n and abs(curve[0]["n_rows"] - 0.3 * n) < 4 * (0.21 * n) ** 0.5
    assert all(0.5 < r["val_f1"] <= 1 and r["time_s"] > 0 for r in curve)
    baseline = models.small_sample_baseline(train, "id", fraction=0.3, max_iter=20)
    assert curve_areas(models.score(baseline.models, val, "id")).first()["auc_roc"] > 0.8


def wide_csv(path, n=300, seed=8):
    """A small file in the 81-column layout, with one line cut short."""
    rng = random.Random(seed)
    names = wide_event_schema().names
    lines = [",".join(names)]
    for _ in range(n):
        label = int(rng.random() < 0.2)
        cells = {name: f"{rng.random() * 3:.2f}" for name in names}
        cells["Label"] = str(label)
        cells["E5"] = "null" if rng.random() < 0.1 else str(3 + 2 * label + rng.randint(0, 1))
        lines.append(",".join(cells[name] for name in names))
    lines.append("1,2,3")
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_all_four_stages_on_the_wide_layout(spark, tmp_path):
    out = str(tmp_path)
    table, bad = stages.ingest(spark, wide_csv(tmp_path / "in.csv"), f"{out}/data", wide_event_schema(), num_files=4)
    assert table.count() == 300 and bad.count() == 1
    stages.build_features(table, f"{out}/features", wide_event_plan(), "row_id", "Label", components=20)
    stored = spark.read.parquet(f"{out}/features/splits")
    assert set(stored.columns) == {
        "row_id", "raw_features", "std_features", "mm_features", "pca_features", "Label", "class_weight", "split",
    }
    widths = stored.select(F.size(vector_to_array("raw_features")), F.size(vector_to_array("pca_features"))).distinct()
    assert [tuple(r) for r in widths.collect()] == [(56, 20)]
    small = {
        "Logistic Regression": models.logistic_regression(label="Label", max_iter=20),
        "GBT": models.boosted_trees(label="Label", iterations=2),
    }
    trained = stages.train_models(
        spark, f"{out}/features", f"{out}/trained", "row_id", "Label", small, {"maxDepth": [2, 3]}, folds=2
    )
    assert set(trained.models) == {*small, stages.BASELINE} == set(trained.seconds)
    # evaluation from the files alone
    ranking = stages.evaluate(
        spark, f"{out}/features", f"{out}/results", "row_id", "Label", f"{out}/trained", replicates=50,
        stability=models.boosted_trees(label="Label", iterations=2, depth=2), folds=2, fractions=(0.5, 1.0),
    )
    assert {r["model"] for r in ranking.collect()} == {*small, stages.BASELINE}
    again = stages.evaluate(spark, f"{out}/features", f"{out}/again", "row_id", "Label", trained, replicates=50, fractions=())
    assert sorted(again.collect()) == sorted(ranking.collect())
    wanted = {
        "confusion": 3, "class_report": 6, "bootstrap_ci": 3, "money_value": 3, "performance": 3, "column_summary": 56, "fold_stability": 2, "learning_curve": 2,
    }
    for name, n in wanted.items():
        assert read_untyped_csv(spark, f"{out}/results/{name}").count() == n, name
    for name in ("roc", "pr"):
        assert read_untyped_csv(spark, f"{out}/results/{name}").count() > 0
    assert read_untyped_csv(spark, f"{out}/trained/importances/gbt").count() == 56
    assert read_untyped_csv(spark, f"{out}/trained/model_comparison").count() == 3
    assert spark.read.json(f"{out}/results/final_ranking").count() == 3
    assert read_untyped_csv(spark, f"{out}/data/missing").count() == 80
    classes = {r["Label"]: int(r["n"]) for r in read_untyped_csv(spark, f"{out}/data/classes").collect()}
    assert sum(classes.values()) == 300 and set(classes) == {"0", "1"}
    assert {r["passed"] for r in read_untyped_csv(spark, f"{out}/data/expectations").collect()} == {"true"}
    assert int(read_untyped_csv(spark, f"{out}/data/files").first()["files"]) >= 2
    assert spark.read.json(f"{out}/data/card").first()["total_rows"] == 300


def test_scores_are_read_twice_in_evaluation(spark, ready, trained, tmp_path):
    """Once for cells in strata and once for thresholds; every table comes from these."""
    from tallyhawk.operators import bootstrap, curves, metrics

    test = ready[2].filter("split = 'test'")
    models.score(trained.models, test, "id").write.parquet(str(tmp_path / "scored"))
    scored = spark.read.parquet(str(tmp_path / "scored"))
    strata = bootstrap.stratum_counts(scored, "id")
    assert sorted(bootstrap.stratum_cells(strata).collect()) == sorted(metrics.confusion(scored).collect())
    counts = curves.threshold_counts(scored)
    direct = sorted(models.performance(scored).collect())
    assert sorted(models.performance_of(curves.areas_of(counts), bootstrap.stratum_cells(strata)).collect()) == direct


class Recorder:
    """Stands in for an estimator: keeps the plans of the rows it is given."""

    def __init__(self, inner, plans):
        self.inner, self.plans = inner, plans

    def copy(self, extra):
        return Recorder(self.inner.copy(extra), self.plans)

    def fit(self, rows):
        self.plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return self.inner.fit(rows)


def test_grid_search_fits_on_stored_rows(ready):
    train = ready[2].filter("split = 'train'").select("id", "label", "std_features", "class_weight")
    plans = []
    models.grid_search(Recorder(models.logistic_regression(max_iter=2), plans), {}, sampling.stratified_folds(train, "id", "label", 2), "id")
    assert len(plans) == 2
    assert all("FileScan parquet" in p and "Window" not in p and "InMemoryTableScan" not in p for p in plans)


def test_a_forest_keeps_places_and_grows_the_same_trees(ready):
    train = ready[2].filter("split = 'train'")
    plain, kept = (models.random_forest(trees=6, depth=6, **extra) for extra in ({"cache_node_ids": False}, {}))
    assert kept.getCacheNodeIds() and not plain.getCacheNodeIds()
    assert models.fit_all(train, {"m": plain}).models["m"].toDebugString.split("\n", 1)[1] == (
        models.fit_all(train, {"m": kept}).models["m"].toDebugString.split("\n", 1)[1]
    )


def test_queries_fit_the_models_they_name_only(spark, small, monkeypatch):
    from tallyhawk.plans import queries_models

    fitted = []
    quick = {
        "Logistic Regression": models.logistic_regression(max_iter=2), "Random Forest": models.random_forest(trees=2, depth=2),
        "GBT": models.boosted_trees(iterations=2, depth=2), "Linear SVC": models.linear_svc(max_iter=2),
    }
    fit_all = models.fit_all
    monkeypatch.setattr(queries_models, "_TRAINED", {})
    monkeypatch.setattr(queries_models, "_STORED", {})
    monkeypatch.setattr(queries_models, "estimators", lambda: quick)
    monkeypatch.setattr(models, "fit_all", lambda rows, made, **more: fitted.append(list(made)) or fit_all(rows, made, **more))
    assert queries_models.l1_iterations(spark, small).first()["iterations"] <= 2
    assert fitted == [["Logistic Regression"]]
    assert queries_models.j2(spark, small).filter("differs").count() == 0
    assert fitted == [["Logistic Regression"], ["GBT"]]
    assert queries_models.t5(spark, small).first()["misplaced"] == 0
    assert {r["model"] for r in queries_models.l8(spark, small).select("model").distinct().collect()} == set(quick)
    assert fitted == [["Logistic Regression"], ["GBT"], ["Random Forest"], ["Linear SVC"]]
