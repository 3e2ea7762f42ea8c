import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyhawk.operators import bootstrap, curves, metrics


def scored(spark, data):
    """data: (model, id, label, score)."""
    df = spark.createDataFrame(data, "model string, id long, label int, score double")
    return df.withColumn("prediction", (F.col("score") > 0).cast("int"))


def sample(n=400, seed=1, ties=True):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        label = int(rng.random() < 0.1)
        for model, noise in (("m", 1.0), ("w", 4.0)):
            score = label * 2 - 1 + rng.gauss(0, noise)
            out.append((model, i, label, round(score, 1) if ties else score))
    return out


def brute_curve(data, model):
    """(score, tp, fp) by descending distinct score."""
    points, tp, fp = [], 0, 0
    for s in sorted({r[3] for r in data if r[0] == model}, reverse=True):
        tp += sum(1 for r in data if r[0] == model and r[3] == s and r[2] == 1)
        fp += sum(1 for r in data if r[0] == model and r[3] == s and r[2] == 0)
        points.append((s, tp, fp))
    return points


@pytest.mark.parametrize("ties", [True, False])
def test_areas_match_brute_force_and_the_unbinned_evaluator(spark, ties):
    data = sample(ties=ties)
    df = scored(spark, data)
    areas = {r["model"]: r for r in curves.curve_areas(df).collect()}
    for model in "mw":
        mine = [r for r in data if r[0] == model]
        pos, neg = [r[3] for r in mine if r[2]], [r[3] for r in mine if not r[2]]
        wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
        assert areas[model]["auc_roc"] == pytest.approx(wins / (len(pos) * len(neg)))
        points, gained, last = brute_curve(data, model), 0.0, 0
        for _, tp, fp in points:
            gained += (tp - last) / len(pos) * tp / (tp + fp)
            last = tp
        assert areas[model]["average_precision"] == pytest.approx(gained)
        vectors = df.filter(F.col("model") == model).select(
            F.col("label").cast("double").alias("label"), array_to_vector(F.array(-F.col("score"), "score")).alias("raw")
        )
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="raw", numBins=0)
        assert areas[model]["auc_roc"] == pytest.approx(evaluator.evaluate(vectors))


def test_area_is_unchanged_by_monotone_score_maps(spark):
    df = scored(spark, sample())
    warped = df.withColumn("score", F.exp(F.col("score")) + 3)
    one = {r["model"]: r["auc_roc"] for r in curves.curve_areas(df).collect()}
    two = {r["model"]: r["auc_roc"] for r in curves.curve_areas(warped).collect()}
    assert one == pytest.approx(two)


@pytest.mark.parametrize("labels,scores,expected", [
    ([0, 0, 1, 1], [1.0, 2.0, 3.0, 4.0], 1.0),
    ([1, 1, 0, 0], [1.0, 2.0, 3.0, 4.0], 0.0),
    ([0, 1, 0, 1], [5.0, 5.0, 5.0, 5.0], 0.5),
    ([1, 1, 1, 1], [1.0, 2.0, 3.0, 4.0], None),
    ([0, 0, 0, 0], [1.0, 2.0, 3.0, 4.0], None),
])
def test_edge_cases(spark, labels, scores, expected):
    df = scored(spark, [("m", i, y, s) for i, (y, s) in enumerate(zip(labels, scores))])
    assert curves.curve_areas(df).first()["auc_roc"] == expected
    assert curves.roc_points(df).count() == len(set(scores)) + 1


def test_roc_runs_from_origin_to_corner_and_thinning_keeps_the_last(spark):
    data = sample()
    df = scored(spark, data)
    full = sorted((r["place"], r["fpr"], r["tpr"]) for r in curves.roc_points(df).filter("model='m'").collect())
    assert full[0] == (0, 0.0, 0.0) and full[-1][1:] == (1.0, 1.0)
    assert all(a[1] <= b[1] and a[2] <= b[2] for a, b in zip(full, full[1:]))
    positives = sum(r[2] for r in data if r[0] == "m")
    assert [p[2] for p in full[1:]] == pytest.approx([tp / positives for _, tp, _ in brute_curve(data, "m")])
    thin = sorted((r["place"], r["fpr"], r["tpr"]) for r in curves.roc_points(df, every=10).filter("model='m'").collect())
    assert thin == [p for p in full if p[0] % 10 == 0 or p[0] == full[-1][0]]


@pytest.mark.parametrize("ties", [True, False])
def test_dropping_collinear_points(spark, ties):
    data = sample(ties=ties, seed=4)
    got = curves.roc_points(scored(spark, data), drop_collinear=True).filter("model='w' and place > 0")
    points = brute_curve(data, "w")
    steps = [(a[1] - b[1], a[2] - b[2]) for a, b in zip(points, [(None, 0, 0), *points])]
    keep = [
        i for i in range(len(points)) if i in (0, len(points) - 1) or steps[i] != steps[i + 1]
    ]
    assert [r["threshold"] for r in got.orderBy("place").collect()] == [points[i][0] for i in keep]
    assert [r["place"] for r in got.orderBy("place").collect()] == list(range(1, len(keep) + 1))


def test_pr_points_run_from_all_rows_to_the_end_point(spark):
    data = sample()
    got = curves.pr_points(scored(spark, data)).filter("model='m'").orderBy("place").collect()
    points = brute_curve(data, "m")
    positives = points[-1][1]
    expected = [(s, tp / (tp + fp), tp / positives) for s, tp, fp in reversed(points)]
    assert [(r["threshold"], r["precision"], r["recall"]) for r in got[:-1]] == expected
    assert (got[-1]["precision"], got[-1]["recall"], got[-1]["threshold"]) == (1.0, 0.0, None)


def test_weighted_metrics_equal_the_library_evaluator(spark):
    df = scored(spark, sample()).filter("model = 'w'")
    ours = metrics.weighted_metrics(metrics.confusion(df)).first()
    typed = df.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    for name, column in (("f1", "f1"), ("accuracy", "accuracy"), ("weightedPrecision", "precision"), ("weightedRecall", "recall")):
        assert ours[column] == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(typed))


def test_published_money_values_follow_from_their_cells(spark):
    # Published confusion cells and totals.
    published = [
        ("Logistic Regression", 20069, 29893, 281, 638952, 7977850),
        ("Random Forest", 18381, 154, 1969, 668691, 5244800),
        ("GBT", 19431, 308, 919, 668537, 7862100),
        ("Linear SVC", 20163, 35610, 187, 633235, 7927000),
    ]
    cells = spark.createDataFrame([r[:5] for r in published], "model string, tp long, fp long, fn long, tn long")
    got = {r["model"]: r["total_value"] for r in metrics.money_value(cells).collect()}
    assert got == {r[0]: r[5] for r in published}
    f1 = {r["model"]: r["f1"] for r in metrics.weighted_metrics(cells).collect()}
    assert {m: round(v, 4) for m, v in f1.items()} == {
        "Logistic Regression": 0.9649, "Random Forest": 0.9968, "GBT": 0.9982, "Linear SVC": 0.9594,
    }
    intervals = {r["model"]: r for r in bootstrap.f1_interval(bootstrap.cell_bootstrap(cells)).collect()}
    # Published bootstrap means and intervals, 1,000 replicates.
    expected = {
        "Logistic Regression": (0.9649, 0.9646, 0.9653),
        "Random Forest": (0.9968, 0.9967, 0.997),
        "GBT": (0.9982, 0.9981, 0.9983),
        "Linear SVC": (0.9594, 0.9591, 0.9598),
    }
    for model, numbers in expected.items():
        r = intervals[model]
        assert (r["mean_f1"], r["ci_lower"], r["ci_upper"]) == pytest.approx(numbers, abs=1.01e-4)


def test_cell_bootstrap_keeps_totals_and_is_reproducible(spark):
    cells = spark.createDataFrame([("m", 5, 10, 3, 82), ("empty", 0, 0, 0, 0)], "model string, tp long, fp long, fn long, tn long")
    draws = bootstrap.cell_bootstrap(cells, 200).collect()
    assert len(draws) == 400
    assert {r["tp"] + r["fp"] + r["fn"] + r["tn"] for r in draws if r["model"] == "m"} == {100}
    assert sorted(map(tuple, draws)) == sorted(map(tuple, bootstrap.cell_bootstrap(cells.repartition(3), 200).collect()))


def test_row_and_cell_bootstrap_agree_in_distribution(spark):
    df = scored(spark, sample(n=1500)).filter("model = 'm'")
    by_rows = bootstrap.f1_interval(bootstrap.row_bootstrap(df, "id", 300)).first()
    by_cells = bootstrap.f1_interval(bootstrap.cell_bootstrap(metrics.confusion(df), 300)).first()
    point = metrics.weighted_metrics(metrics.confusion(df)).first()["f1"]
    for ci in (by_rows, by_cells):
        assert ci["ci_lower"] < point < ci["ci_upper"]
    assert by_rows["mean_f1"] == pytest.approx(by_cells["mean_f1"], abs=0.003)
    assert by_rows["ci_upper"] - by_rows["ci_lower"] == pytest.approx(by_cells["ci_upper"] - by_cells["ci_lower"], rel=0.3)


def test_class_report_of_a_model_that_never_predicts_positive(spark):
    cells = spark.createDataFrame([("m", 0, 0, 4, 6)], "model string, tp long, fp long, fn long, tn long")
    report = {r["class"]: r for r in metrics.class_report(cells).collect()}
    assert (report[1]["precision"], report[1]["recall"], report[1]["f1"], report[1]["support"]) == (0.0, 0.0, 0.0, 4)
    assert report[0]["recall"] == 1.0


def test_stratum_draws_have_poisson_moments_and_do_not_depend_on_placement(spark):
    counts = spark.createDataFrame([("m", "11", 0, 3), ("m", "01", 0, 200), ("m", "10", 1, 1000), ("m", "00", 2, 2_000_000_000)], "model string, cell string, stratum int, n long")
    draws = bootstrap.stratum_bootstrap(counts, 3000)
    got = draws.orderBy("replicate").collect()
    assert got == bootstrap.stratum_bootstrap(counts.repartition(5), 3000).orderBy("replicate").collect() and len(got) == 3000
    for cell, n in (("tp", 3), ("fp", 200), ("fn", 1000), ("tn", 2_000_000_000)):
        values = [r[cell] for r in got]
        mean = sum(values) / 3000
        variance = sum((v - mean) ** 2 for v in values) / 2999
        assert abs(mean - n) < 4 * (n / 3000) ** 0.5 and variance == pytest.approx(n, rel=0.15)


def test_normal_quantile_with_skewness_is_close_to_poisson():
    import math
    from statistics import NormalDist

    from tallyhawk.functions.hashing import poisson_cdf

    mean, exact = 256, poisson_cdf(256)
    for k in range(180, 340, 3):
        # the share of normal numbers whose draw is k at most: solve mean + sqrt(mean) z + (z^2 - 1) / 6 = k + 1/2
        root = math.sqrt(mean - 4 / 6 * (mean - 1 / 6 - k - 0.5))
        assert abs(NormalDist().cdf(3 * (root - math.sqrt(mean))) - exact[k]) < 1e-3


def test_stratum_and_row_bootstrap_agree(spark):
    df = spark.range(4000).select("id", F.lit("m").alias("model"), (F.col("id") % 9 == 0).cast("int").alias("label"),
                                  (F.col("id") % 10 < 2).cast("int").alias("prediction"))
    counts = bootstrap.stratum_counts(df, "id")
    assert counts.agg(F.sum("n")).first()[0] == 4000 and counts.count() <= 4 * bootstrap.STRATA
    a = bootstrap.f1_interval(bootstrap.stratum_bootstrap(counts, 400)).first()
    b = bootstrap.f1_interval(bootstrap.row_bootstrap(df, "id", 400)).first()
    assert a["mean_f1"] == pytest.approx(b["mean_f1"], abs=0.003)
    assert a["ci_upper"] - a["ci_lower"] == pytest.approx(b["ci_upper"] - b["ci_lower"], rel=0.3)
