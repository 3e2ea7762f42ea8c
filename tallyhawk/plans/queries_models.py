"""Queries that fit stages and models on the entity table, at full settings.

What iteration finds has no SQL equivalent, but what it must satisfy has: scores recomputed from coefficients or from the nodes of the
trees, gradients that vanish, directions that are eigenvectors. Such queries return how many rows disagree, next to
counts of the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhawk.operators import linear, metrics, models, preprocessing, projection, quality, sampling, tables, trees
from tallyhawk.plans.entities import PLAN, labelled_splits, split_frame
from tallyhawk.plans.queries_features import SPLIT, feature_table_sql
from tallyhawk.plans.registry import ENTITIES, query, rounded
from tallyhawk.session import cut_lineage, scratch_path
from tallyhawk.sources import writers
from tallyhawk.sources.readers import read_table

COMPONENTS = 20
KEY = "entity_id"


@dataclass
class Prepared:
    fitted: PipelineModel
    splits: DataFrame

    def part(self, name: str) -> DataFrame:
        return split_frame(self.splits, name)


_PREPARED: dict[tuple[str, str], Prepared] = {}
_TRAINED: dict[tuple[str, str], models.Trained] = {}
_STORED: dict[tuple[str, ...], str] = {}
LOGISTIC, FOREST, BOOSTED, SVC = "Logistic Regression", "Random Forest", "GBT", "Linear SVC"


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    """Fitted preprocessing and stored, vectorised splits; built once per application and data folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _PREPARED:
        parts = cut_lineage(labelled_splits(spark, sf_dir))
        train = split_frame(parts, "train")
        fitted = preprocessing.fit_preprocessing(train, PLAN, COMPONENTS)
        ready = sampling.class_weights(fitted.transform(parts), counted=train)
        vectors = ["raw_features", "std_features", "mm_features", "pca_features"]
        stored = cut_lineage(ready.select(KEY, "label", "split", "class_weight", *vectors))
        _PREPARED[at] = Prepared(fitted, stored)
    return _PREPARED[at]


def estimators() -> dict:
    return {
        LOGISTIC: models.logistic_regression(),
        FOREST: models.random_forest(),
        BOOSTED: models.boosted_trees(),
        SVC: models.linear_svc(),
    }


def trained(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> models.Trained:
    """The named models, or all four. Each is fitted when it is first asked for, once per application and data folder."""
    known = _TRAINED.setdefault((spark.sparkContext.applicationId, sf_dir), models.Trained())
    every = estimators()
    wanted = [n for n in every if names is None or n in names]
    absent = {n: every[n] for n in wanted if n not in known.models}
    if absent:
        found = models.fit_all(prepared(spark, sf_dir).part("train"), absent)
        known.models |= found.models
        known.seconds |= found.seconds
    return models.Trained({n: known.models[n] for n in wanted}, {n: known.seconds[n] for n in wanted})


def stored_models(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> str:
    """The folder that the named models, or all four, are saved in, with their index."""
    found = trained(spark, sf_dir, names)
    at = (spark.sparkContext.applicationId, sf_dir, *found.models)
    if at not in _STORED:
        path = scratch_path(spark, "models")
        writers.save_models(spark, found.models, found.seconds, path)
        _STORED[at] = path
    return _STORED[at]


def scored_test(spark: SparkSession, sf_dir: str, names: list[str] | None = None, part: str = "test") -> DataFrame:
    return models.score(trained(spark, sf_dir, names).models, prepared(spark, sf_dir).part(part), KEY)


@query("f2_assembled_width", f"SELECT {len(PLAN.names)}::INT AS min_width, {len(PLAN.names)}::INT AS max_width FROM (SELECT COUNT(*) FROM events)")
def f2(spark, sf_dir):
    return quality.vector_width(prepared(spark, sf_dir).splits, "raw_features")


@query("a20_vector_width", f"SELECT {COMPONENTS}::INT AS min_width, {COMPONENTS}::INT AS max_width FROM (SELECT COUNT(*) FROM events)")
def a20(spark, sf_dir):
    return quality.vector_width(prepared(spark, sf_dir).splits, "pca_features")


@query(
    "p16_feature_registry",
    f"WITH {feature_table_sql()} SELECT idx, name AS feature, COUNT(*) AS n, ROUND(AVG(x),6)+0.0 AS mean, ROUND(VAR_SAMP(x),4)+0.0 AS variance, "
    "COUNT(*) FILTER (x <> 0) AS nonzeros FROM every JOIN places USING (name) GROUP BY idx, name",
)
def p16(spark, sf_dir):
    ready = prepared(spark, sf_dir)
    assembled = ready.fitted.transform(labelled_splits(spark, sf_dir))
    table = preprocessing.described_registry(assembled, "raw_features")
    return table.withColumns({"mean": F.round("mean", 6), "variance": F.round("variance", 4)})


@query(
    "f3_standardised_vectors",
    f"WITH {feature_table_sql()}, k AS (SELECT name, AVG(x) AS m, STDDEV_SAMP(x) AS s FROM long GROUP BY name) "
    "SELECT entity_id, idx, ROUND(CASE WHEN s > 0 THEN (x-m)/s ELSE 0 END, 6)+0.0 AS value "
    "FROM every JOIN k USING (name) JOIN places USING (name)",
)
def f3_vectors(spark, sf_dir):
    return rounded(preprocessing.scaled_columns(prepared(spark, sf_dir).splits, "std_features", KEY))


@query(
    "f4_min_max_vectors",
    f"WITH {feature_table_sql()}, k AS (SELECT name, MIN(x) AS a, MAX(x) AS z FROM long GROUP BY name) "
    "SELECT entity_id, idx, ROUND(CASE WHEN z > a THEN (x-a)/(z-a) ELSE 0.5 END, 6)+0.0 AS value "
    "FROM every JOIN k USING (name) JOIN places USING (name)",
)
def f4_vectors(spark, sf_dir):
    return rounded(preprocessing.scaled_columns(prepared(spark, sf_dir).splits, "mm_features", KEY))


@query(
    "f5_projected_vectors",
    f"WITH {feature_table_sql()}, k AS (SELECT name, AVG(x) AS m, STDDEV_SAMP(x) AS s FROM long GROUP BY name) "
    "SELECT entity_id, ROUND(SUM(CASE WHEN s > 0 THEN ((x-m)/s)*((x-m)/s) ELSE 0 END), 4) AS squared_length, TRUE AS prefix_fits "
    "FROM every JOIN k USING (name) GROUP BY entity_id",
)
def f5_vectors(spark, sf_dir):
    """All rows under a projection that keeps every direction: it only turns vectors, so lengths stay those of the standardised columns, and
    no row is longer under the stored projection, which keeps the first directions."""
    ready = prepared(spark, sf_dir)
    turn = PCA(k=len(PLAN.names), inputCol="std_features", outputCol="turned").fit(ready.part("train"))

    def square(vector: str):
        return F.aggregate(vector_to_array(vector), F.lit(0.0), lambda s, x: s + x * x)

    rows = turn.transform(ready.splits).select(KEY, square("turned").alias("squared_length"), square("pca_features").alias("kept"))
    fits = F.col("kept") <= F.col("squared_length") + 1e-6 * F.greatest("squared_length", F.lit(1.0))
    return rows.select(KEY, F.round("squared_length", 4).alias("squared_length"), fits.alias("prefix_fits"))


@query("f5_projected_values")
def f5_values(spark, sf_dir):
    return rounded(preprocessing.scaled_columns(prepared(spark, sf_dir).splits, "pca_features", KEY))


@query(
    "w1_explained_variance",
    f"WITH {feature_table_sql()}, k AS (SELECT name FROM long GROUP BY name HAVING STDDEV_SAMP(x) > 0) "
    f"SELECT UNNEST(range(1, {COMPONENTS + 1}))::INT AS component, COUNT(*)::DOUBLE AS n_varying, TRUE AS is_eigenvector, TRUE AS share_agrees FROM k",
)
def w1(spark, sf_dir):
    """Every stored direction is an eigenvector of the training rows' covariances and has the share of variance that the fit reports."""
    ready = prepared(spark, sf_dir)
    report = projection.projection_report(ready.part("train"), "std_features", ready.fitted.stages[-1])
    return rounded(report.select("component", "n_varying", "is_eigenvector", "share_agrees"))


@query("w1_cumulative_shares")
def w1_shares(spark, sf_dir):
    ready = prepared(spark, sf_dir)
    return rounded(preprocessing.explained_variance(ready.fitted, ready.splits))


@query(
    "f5_embedding_variance",
    "WITH long AS (SELECT UNNEST(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), "
    "k AS (SELECT i FROM long GROUP BY i HAVING STDDEV_SAMP(x) > 0) "
    "SELECT UNNEST(range(1, 21))::INT AS component, COUNT(*)::DOUBLE AS n_varying, TRUE AS is_eigenvector, TRUE AS share_agrees FROM k",
)
def f5_embeddings(spark, sf_dir):
    """A projection of the 64-wide embeddings, checked against their covariances."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector

    vectors = read_table(spark, sf_dir, "embeddings").select(array_to_vector("embedding").alias("raw"))
    stages = [
        StandardScaler(inputCol="raw", outputCol="std", withMean=True, withStd=True),
        PCA(k=20, inputCol="std", outputCol="pca"),
    ]
    fitted = Pipeline(stages=stages).fit(vectors)
    report = projection.projection_report(fitted.transform(vectors).select("std"), "std", fitted.stages[-1])
    return rounded(report.select("component", "n_varying", "is_eigenvector", "share_agrees"))


@query(
    "f7_saved_and_reloaded_preprocessing",
    f"WITH {ENTITIES} SELECT COUNT(*) AS n_rows, 0::BIGINT AS changed FROM entities",
)
def f7(spark, sf_dir):
    """Rows whose vectors differ after the fitted stages were saved and loaded again: none."""
    path = scratch_path(spark, "stages")
    ready = prepared(spark, sf_dir)
    writers.save_stage(ready.fitted, path)
    again = PipelineModel.load(path).transform(labelled_splits(spark, sf_dir))
    both = ready.splits.select(KEY, F.col("std_features").alias("before")).join(again.select(KEY, "std_features"), KEY)
    changed = F.col("before").cast("string") != F.col("std_features").cast("string")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(changed).alias("changed"))


def _agreement(name: str, rows: DataFrame, again) -> DataFrame:
    """(model, n_rows, positives, disagreements) of rows with ``score``, ``prediction`` and the score ``again`` from the model's own numbers."""
    raw = F.lit(0.0 if name == SVC else 0.5)
    differs = (F.abs(F.col("score") - again) > 1e-9 * F.greatest(F.abs("score"), F.lit(1.0))) | again.isNull()
    clear = F.abs(again - raw) > 1e-9
    differs = differs | (clear & ((again > raw).cast("int") != F.col("prediction")))
    return rows.agg(
        F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("positives"), F.count_if(differs).alias("disagreements")
    )


def linear_agreement(spark, sf_dir, name: str, part: DataFrame) -> DataFrame:
    """Scores of a fitted linear model against its coefficients."""
    model = trained(spark, sf_dir, [name]).models[name]
    recompute = linear.margin if name == SVC else linear.logistic_score
    again = recompute(F.col("x"), list(model.coefficients.toArray()), model.intercept)
    rows = models.score({name: model}, part, KEY).join(part.select(KEY, vector_to_array("std_features").alias("x")), KEY)
    return _agreement(name, rows, again)


def tree_agreement(spark, sf_dir, name: str, part: DataFrame) -> DataFrame:
    """Scores of a fitted ensemble against a descent over its stored nodes."""
    path = f"{stored_models(spark, sf_dir, [name])}/{name.lower().replace(' ', '_')}"
    nodes = trees.stored_nodes(spark, path)
    found = trees.ensemble_scores(part, nodes, KEY, trees.stored_depth(spark, path), boosted=name == BOOSTED)
    rows = models.score(trained(spark, sf_dir, [name]).models, part, KEY)
    return _agreement(name, rows.join(found.withColumnRenamed("score", "again"), KEY, "left"), F.col("again"))


def agreement_sql(name: str, where: str = "") -> str:
    return (
        f"SELECT '{name}' AS model, COUNT(*) AS n_rows, SUM(label)::BIGINT AS positives, 0::BIGINT AS disagreements{{more}} FROM parts {where}"
    )


def _linear_sql(name: str) -> str:
    return f"WITH {SPLIT} " + agreement_sql(name).format(more=", TRUE AS optimal")


@query("l1_logistic_regression", _linear_sql(LOGISTIC))
def l1(spark, sf_dir):
    """All rows score as the coefficients say, and at these the gradient of the training loss is a thousandth of that at zero or less."""
    ready, model = prepared(spark, sf_dir), trained(spark, sf_dir, [LOGISTIC]).models[LOGISTIC]
    found = linear.logistic_gradient(ready.part("train"), list(model.coefficients.toArray()), model.intercept, model.getRegParam())
    optimal = found.select(F.col("gradient") <= 1e-3 * F.col("at_zero")).scalar()
    return linear_agreement(spark, sf_dir, LOGISTIC, ready.splits).withColumn("optimal", optimal)


@query("l4_linear_svc", _linear_sql(SVC))
def l4(spark, sf_dir):
    """The same for the hinge loss. Its solver ends after 100 iterations on a loss with kinks, so the bound is a fiftieth."""
    ready, model = prepared(spark, sf_dir), trained(spark, sf_dir, [SVC]).models[SVC]
    found = linear.hinge_gradient(ready.part("train"), list(model.coefficients.toArray()), model.intercept, model.getRegParam())
    optimal = found.select(F.col("gradient") <= 0.02 * F.col("at_zero")).scalar()
    return linear_agreement(spark, sf_dir, SVC, ready.splits).withColumn("optimal", optimal)


@query("l2_random_forest", f"WITH {SPLIT} " + agreement_sql(FOREST, "WHERE split = 'test'").format(more=""))
def l2(spark, sf_dir):
    return tree_agreement(spark, sf_dir, FOREST, prepared(spark, sf_dir).part("test"))


@query("l3_boosted_trees", f"WITH {SPLIT} " + agreement_sql(BOOSTED, "WHERE split = 'test'").format(more=""))
def l3(spark, sf_dir):
    return tree_agreement(spark, sf_dir, BOOSTED, prepared(spark, sf_dir).part("test"))


@query("e10_fitted_performance")
def e10_fitted(spark, sf_dir):
    """Metrics of the four models and the baseline on the test rows."""
    ready = prepared(spark, sf_dir)
    everyone = {**trained(spark, sf_dir).models, **models.small_sample_baseline(ready.part("train"), KEY).models}
    return rounded(models.performance(cut_lineage(models.score(everyone, ready.part("test"), KEY))))


@query("l1_iterations")
def l1_iterations(spark, sf_dir):
    model = trained(spark, sf_dir, [LOGISTIC]).models[LOGISTIC]
    table = spark.createDataFrame([(model.summary.totalIterations,)], "iterations int")
    return table.withColumn("train_rows", prepared(spark, sf_dir).part("train").agg(F.count(F.lit(1))).scalar())


def folded(spark, sf_dir, folds: int) -> DataFrame:
    train = prepared(spark, sf_dir).part("train").select(KEY, "label", "raw_features")
    return sampling.stratified_folds(train, KEY, "label", folds)


@query("l5_grid_search")
def l5(spark, sf_dir):
    grid = {"maxDepth": [4, 6], "stepSize": [0.05, 0.1, 0.2]}
    results = models.grid_search(models.boosted_trees(), grid, folded(spark, sf_dir, 3), KEY, parallelism=4)
    return rounded(models.fold_summary(results, list(grid)))


@query("l6_fold_stability")
def l6(spark, sf_dir):
    return rounded(models.grid_search(models.boosted_trees(iterations=30), {}, folded(spark, sf_dir, 5), KEY, parallelism=4))


@query("l7_small_sample_baseline")
def l7(spark, sf_dir):
    ready = prepared(spark, sf_dir)
    baseline = models.small_sample_baseline(ready.part("train"), KEY)
    return rounded(models.performance(models.score(baseline.models, ready.part("test"), KEY)))


@query("l8_batch_scores")
def l8(spark, sf_dir):
    return rounded(scored_test(spark, sf_dir))


@query(
    "p15_positive_score_range",
    f"WITH {SPLIT} " + " UNION ALL ".join(agreement_sql(n, "WHERE split = 'test'").format(more="") for n in (LOGISTIC, FOREST, BOOSTED, SVC)),
)
def p15(spark, sf_dir):
    """The positive class's score of every model, a probability or a margin, against one recomputed from the model's numbers."""
    test = prepared(spark, sf_dir).part("test")
    parts = [linear_agreement(spark, sf_dir, n, test) for n in (LOGISTIC, SVC)] + [tree_agreement(spark, sf_dir, n, test) for n in (FOREST, BOOSTED)]
    return tables.stack(*parts)


@query("p15_score_ends")
def p15_ends(spark, sf_dir):
    scored = scored_test(spark, sf_dir)
    return rounded(scored.groupBy("model").agg(F.min("score").alias("lowest"), F.max("score").alias("highest")))


IMPORTANCES_SQL = (
    f"WITH {feature_table_sql()} SELECT idx, name AS feature, COUNT(*) FILTER (x <> 0) AS nonzeros, FALSE AS differs "
    "FROM long JOIN places USING (name) GROUP BY idx, name"
)


def importances_agree(spark, sf_dir, name: str) -> DataFrame:
    """(idx, feature, nonzeros, differs): whether a feature's importance in the model is another than its share of the gains of the stored nodes."""
    ready, path = prepared(spark, sf_dir), f"{stored_models(spark, sf_dir, [name])}/{name.lower().replace(' ', '_')}"
    nodes = trees.node_importances(trees.stored_nodes(spark, path), boosted=name == BOOSTED)
    reported = models.feature_importance(trained(spark, sf_dir, [name]).models[name], ready.splits, top=None)
    registry = preprocessing.described_registry(ready.part("train"), "raw_features")
    both = registry.join(reported.withColumnRenamed("importance", "reported"), "feature", "left").join(nodes, "idx", "left")
    differs = F.abs(F.coalesce("importance", F.lit(0.0)) - F.col("reported")) > 1e-9
    return both.select("idx", "feature", "nonzeros", F.coalesce(differs, F.lit(True)).alias("differs"))


@query("l9_feature_importance", IMPORTANCES_SQL)
def l9(spark, sf_dir):
    return importances_agree(spark, sf_dir, FOREST)


@query("j2_named_importances", IMPORTANCES_SQL)
def j2(spark, sf_dir):
    return importances_agree(spark, sf_dir, BOOSTED)


@query(
    "t5_top_20_features",
    f"WITH {feature_table_sql()} SELECT COUNT(DISTINCT name) AS n_features, least(20, COUNT(DISTINCT name)) AS kept, 0::BIGINT AS misplaced FROM long",
)
def t5(spark, sf_dir):
    """The 20 features with the greatest importance; misplaced is one left out although the stored nodes give it more than one kept has."""
    path = f"{stored_models(spark, sf_dir, [FOREST])}/random_forest"
    ready = prepared(spark, sf_dir)
    nodes = trees.node_importances(trees.stored_nodes(spark, path), boosted=False)
    top = models.feature_importance(trained(spark, sf_dir, [FOREST]).models[FOREST], ready.splits, top=20).select("feature", F.lit(True).alias("top"))
    every = preprocessing.feature_registry(ready.splits, "raw_features").join(nodes, "idx", "left").join(top, "feature", "left")
    every = every.select(F.coalesce("importance", F.lit(0.0)).alias("importance"), F.coalesce("top", F.lit(False)).alias("top"))
    least = every.filter("top").agg(F.min("importance")).scalar()
    return every.agg(
        F.count(F.lit(1)).alias("n_features"), F.count_if("top").alias("kept"),
        F.count_if(~F.col("top") & (F.col("importance") > least + 1e-9)).alias("misplaced"),
    )


def _importance_values(name: str, top: int | None):
    def run(spark, sf_dir):
        return rounded(models.feature_importance(trained(spark, sf_dir, [name]).models[name], prepared(spark, sf_dir).splits, top=top))

    return run


query("l9_importance_values")(_importance_values(FOREST, None))
query("j2_importance_values")(_importance_values(BOOSTED, None))
query("t5_top_20_values")(_importance_values(FOREST, 20))


@query("l10_learning_curve")
def l10(spark, sf_dir):
    ready = prepared(spark, sf_dir)
    columns = [KEY, "label", "std_features"]
    return rounded(models.learning_curve(ready.part("train").select(*columns), ready.part("val").select(*columns), KEY))


@query("e9_model_comparison")
def e9(spark, sf_dir):
    return rounded(models.model_comparison(scored_test(spark, sf_dir, part="val"), trained(spark, sf_dir).seconds))


@query("e11_final_ranking")
def e11_final(spark, sf_dir):
    """The flagship: features, split, four models, test metrics, money value and ranking."""
    scored = cut_lineage(scored_test(spark, sf_dir))
    value = metrics.money_value(metrics.confusion(scored)).select("model", "total_value")
    return rounded(metrics.rank_models(models.performance(scored).join(value, "model"), ["f1", "total_value"]))


@query(
    "s13_saved_and_reloaded_models",
    f"WITH {SPLIT} SELECT UNNEST(['Logistic Regression','Random Forest','GBT','Linear SVC']) AS model, "
    "COUNT(*) AS n_rows, 0::BIGINT AS changed FROM parts WHERE split = 'test'",
)
def s13(spark, sf_dir):
    """Test rows that a model loaded by its metadata predicts differently: none."""
    reloaded, _ = writers.load_models(spark, stored_models(spark, sf_dir))
    test = prepared(spark, sf_dir).part("test")
    before = scored_test(spark, sf_dir).select("model", KEY, F.col("prediction").alias("before"))
    both = before.join(models.score(reloaded, test, KEY), ["model", KEY])
    changed = F.count_if(F.col("before") != F.col("prediction")).alias("changed")
    return both.groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"), changed)
