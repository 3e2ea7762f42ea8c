"""Queries over scored tables. Two fixed linear scorers stand in for models, so that SQL can follow."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhawk.functions.hashing import HASH_SPACE, key_bucket, poisson_cdf
from tallyhawk.operators import bootstrap, curves, metrics, quality, tables
from tallyhawk.plans.entities import entities, scored_entities
from tallyhawk.plans.queries_features import poisson_sql
from tallyhawk.plans.registry import (
    ACCURACY_SQL, CELLS, CURVE, ENTITIES, F1_SQL, PRECISION_SQL, SCORED, bucket_sql, hash_sql, query, rounded,
)


@query(
    "e1_confusion",
    f"WITH {CELLS} SELECT model, tp, fp, fn, tn, "
    + ", ".join(f"ROUND({c}/(tp+fp+fn+tn)::DOUBLE*100,4) AS {c}_pct" for c in ("tp", "fp", "fn", "tn"))
    + " FROM cells",
)
def e1(spark, sf_dir):
    return metrics.confusion_shares(metrics.confusion(scored_entities(spark, sf_dir)))


@query(
    "e2_areas",
    f"WITH {CURVE} SELECT model, ROUND(SUM(neg*(tp-pos/2.0))/(MAX(positives)*MAX(negatives)),6) AS auc_roc, "
    "ROUND(SUM(pos*tp/(tp+fp)::DOUBLE)/MAX(positives),6) AS average_precision FROM curve GROUP BY model",
)
def e2(spark, sf_dir):
    return rounded(curves.curve_areas(scored_entities(spark, sf_dir)))


@query(
    "e3_weighted_metrics",
    f"WITH {CELLS} SELECT model, ROUND({F1_SQL},6) AS f1, ROUND({ACCURACY_SQL},6) AS accuracy, "
    f"ROUND({PRECISION_SQL},6) AS precision, ROUND({ACCURACY_SQL},6) AS recall FROM cells",
)
def e3(spark, sf_dir):
    return rounded(metrics.weighted_metrics(metrics.confusion(scored_entities(spark, sf_dir))))


@query(
    "e4_class_report",
    f"WITH {CELLS} SELECT model, 1::INT AS class, ROUND(tp/(tp+fp)::DOUBLE,6) AS precision, ROUND(tp/(tp+fn)::DOUBLE,6) AS recall, "
    "ROUND(2.0*tp/(2*tp+fp+fn),6) AS f1, tp+fn AS support FROM cells UNION ALL "
    "SELECT model, 0::INT, ROUND(tn/(tn+fn)::DOUBLE,6), ROUND(tn/(tn+fp)::DOUBLE,6), ROUND(2.0*tn/(2*tn+fp+fn),6), tn+fp FROM cells",
)
def e4(spark, sf_dir):
    return rounded(metrics.class_report(metrics.confusion(scored_entities(spark, sf_dir))))


@query(
    "w2_running_counts",
    f"WITH {CURVE} SELECT model, score, tp::BIGINT AS tp, fp::BIGINT AS fp, place FROM curve",
)
def w2(spark, sf_dir):
    return curves.threshold_counts(scored_entities(spark, sf_dir)).select("model", "score", "tp", "fp", "place")


ROC = (
    CURVE + ", points AS (SELECT model, place, places, score AS threshold, fp/negatives::DOUBLE AS fpr, "
    "tp/positives::DOUBLE AS tpr FROM curve UNION ALL SELECT DISTINCT model, 0, places, 'Infinity'::DOUBLE, 0, 0 FROM curve)"
)


@query(
    "e5_roc_points",
    f"WITH {ROC} SELECT model, place, threshold, ROUND(fpr,6) AS fpr, ROUND(tpr,6) AS tpr FROM (SELECT * REPLACE (CASE WHEN place > 0 THEN threshold END AS threshold) FROM points)",
)
def e5(spark, sf_dir):
    """All points; the origin's threshold, infinity, is shown as null."""
    points = rounded(curves.roc_points(scored_entities(spark, sf_dir)))
    return points.withColumn("threshold", F.when(F.col("place") > 0, F.col("threshold")))


@query(
    "w4_thinned_roc",
    f"WITH {ROC} SELECT model, place, ROUND(fpr,6) AS fpr, ROUND(tpr,6) AS tpr FROM points WHERE place % 50 = 0 OR place = places",
)
def w4(spark, sf_dir):
    points = curves.roc_points(scored_entities(spark, sf_dir), every=50)
    return rounded(points.select("model", "place", "fpr", "tpr"))


CORNERS = (
    CURVE + ", steps AS (SELECT *, LEAD(pos) OVER v AS np, LEAD(neg) OVER v AS nn FROM curve "
    "WINDOW v AS (PARTITION BY model ORDER BY score DESC)), "
    "bends AS (SELECT model, score, tp, fp, positives, negatives, "
    "row_number() OVER (PARTITION BY model ORDER BY score DESC) AS place, COUNT(*) OVER (PARTITION BY model) AS places "
    "FROM steps WHERE place = 1 OR np IS NULL OR np <> pos OR nn <> neg)"
)


@query(
    "e5_roc_corners_thinned",
    f"WITH {CORNERS}, a AS (SELECT model, ROUND(SUM(neg*(tp-pos/2.0))/(MAX(positives)*MAX(negatives)),6) AS auc_roc FROM curve GROUP BY model), "
    "p AS (SELECT model, place, fp/negatives::DOUBLE AS fpr, tp/positives::DOUBLE AS tpr FROM bends WHERE place % 50 = 0 OR place = places "
    "UNION ALL SELECT DISTINCT model, 0, 0, 0 FROM bends) "
    "SELECT model, place, ROUND(fpr,6) AS fpr, ROUND(tpr,6) AS tpr, auc_roc FROM p JOIN a USING (model)",
)
def e5_corners(spark, sf_dir):
    scored = scored_entities(spark, sf_dir)
    points = curves.roc_points(scored, every=50, drop_collinear=True).drop("threshold")
    return rounded(curves.with_area(points, curves.curve_areas(scored), "auc_roc"))


PR = (
    CURVE + ", points AS (SELECT model, places-place AS place, score AS threshold, tp/(tp+fp)::DOUBLE AS precision, "
    "tp/positives::DOUBLE AS recall, places FROM curve UNION ALL SELECT DISTINCT model, places, NULL::DOUBLE, 1, 0, places FROM curve)"
)


@query(
    "e6_pr_points",
    f"WITH {PR} SELECT model, place, threshold, ROUND(precision,6) AS precision, ROUND(recall,6) AS recall FROM points",
)
def e6(spark, sf_dir):
    return rounded(curves.pr_points(scored_entities(spark, sf_dir)))


@query(
    "e6_pr_thinned",
    f"WITH {PR}, a AS (SELECT model, ROUND(SUM(pos*tp/(tp+fp)::DOUBLE)/MAX(positives),6) AS average_precision FROM curve GROUP BY model) "
    "SELECT model, place, ROUND(precision,6) AS precision, ROUND(recall,6) AS recall, average_precision FROM points JOIN a USING (model) "
    "WHERE place % 50 = 0 OR place = places",
)
def e6_thinned(spark, sf_dir):
    scored = scored_entities(spark, sf_dir)
    points = curves.pr_points(scored, every=50).drop("threshold")
    return rounded(curves.with_area(points, curves.curve_areas(scored), "average_precision"))


BOOTSTRAP_CELLS = (
    f"{SCORED}, {poisson_sql('scored', 20)}, resampled AS (SELECT model, replicate, "
    + ", ".join(
        f"SUM(CASE WHEN label={y} AND prediction={p} THEN weight ELSE 0 END)::BIGINT AS {c}"
        for c, y, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))
    )
    + " FROM drawn WHERE weight > 0 GROUP BY model, replicate)"
)


@query("m12_bootstrap_rows", f"WITH {BOOTSTRAP_CELLS} SELECT * FROM resampled")
def m12_rows(spark, sf_dir):
    return bootstrap.row_bootstrap(scored_entities(spark, sf_dir), "entity_id", 20)


def _stratum_sql() -> str:
    """``resampled``: 1,000 replicates of the cells from Poisson draws of stratum counts."""
    digits, tables = bootstrap.DIGITS, []
    for digit in range(digits):
        bounds = poisson_cdf(1 << digit)
        # a draw is how many bounds are at or below the uniform number: the last entry whose bound is
        tables += [f"({digit},0,-1.0)"] + [f"({digit},{k + 1},{bound!r})" for k, bound in enumerate(bounds)]
    name = "model||'|'||cell||'|'||stratum||'|'||digit"

    def unit(salt: str) -> str:
        text = f"{name}||'-'||{salt}replicate"
        return hash_sql(text) + f"/{HASH_SPACE}::DOUBLE"
    return (
        f"{SCORED}, strata AS (SELECT model, label::VARCHAR||prediction::VARCHAR AS cell, {bucket_sql('entity_id', bootstrap.STRATA, 'stratum')} AS stratum, "
        f"COUNT(*) AS n FROM scored GROUP BY 1, 2, 3), tables(digit, k, bound) AS (VALUES {', '.join(tables)}), "
        f"draws AS (SELECT *, {unit('')} AS u, {unit("'v'||")} AS v FROM "
        f"(SELECT *, n - n % {1 << digits} AS high FROM strata, (SELECT UNNEST(range({digits + 1}))::INT AS digit) "
        f"WHERE CASE WHEN digit < {digits} THEN (n >> digit) % 2 = 1 ELSE n >= {1 << digits} END), (SELECT UNNEST(range(1000))::INT AS replicate)), "
        "normal AS (SELECT *, sqrt(-2*ln(1-u))*cos(2*pi()*v) AS z FROM draws), "
        f"weights AS (SELECT model, cell, replicate, k::BIGINT AS weight FROM (SELECT * FROM draws WHERE digit < {digits}) d "
        "ASOF JOIN tables t ON d.digit = t.digit AND d.u >= t.bound "
        f"UNION ALL SELECT model, cell, replicate, greatest(0, floor(high + sqrt(high)*z + (z*z-1)/6 + 0.5))::BIGINT FROM normal WHERE digit = {digits}), "
        "resampled AS (SELECT model, replicate, "
        + ", ".join(f"SUM(CASE WHEN cell='{code}' THEN weight ELSE 0 END)::BIGINT AS {c}" for c, code in (("tp", "11"), ("fp", "01"), ("fn", "10"), ("tn", "00")))
        + " FROM weights GROUP BY model, replicate)"
    )


STRATUM_CELLS = _stratum_sql()


def stratum_replicates(spark, sf_dir):
    return bootstrap.stratum_bootstrap(bootstrap.stratum_counts(scored_entities(spark, sf_dir), "entity_id"), 1000)


@query("m12_bootstrap_cells", f"WITH {STRATUM_CELLS} SELECT * FROM resampled")
def m12_cells(spark, sf_dir):
    return stratum_replicates(spark, sf_dir)


@query(
    "e7_bootstrap_interval_rows",
    f"WITH {BOOTSTRAP_CELLS}, r AS (SELECT model, {F1_SQL} AS f1 FROM resampled) "
    "SELECT model, ROUND(AVG(f1),6) AS mean_f1, ROUND(quantile_cont(f1,0.025),6) AS ci_lower, "
    "ROUND(quantile_cont(f1,0.975),6) AS ci_upper FROM r GROUP BY model",
)
def e7_rows(spark, sf_dir):
    drawn = bootstrap.row_bootstrap(scored_entities(spark, sf_dir), "entity_id", 20)
    return rounded(bootstrap.f1_interval(drawn))


@query(
    "e7_bootstrap_interval",
    f"WITH {STRATUM_CELLS}, r AS (SELECT model, {F1_SQL} AS f1 FROM resampled) "
    "SELECT model, ROUND(AVG(f1),6) AS mean_f1, ROUND(quantile_cont(f1,0.025),6) AS ci_lower, "
    "ROUND(quantile_cont(f1,0.975),6) AS ci_upper FROM r GROUP BY model",
)
def e7(spark, sf_dir):
    return rounded(bootstrap.f1_interval(stratum_replicates(spark, sf_dir)))


@query("e7_bootstrap_interval_multinomial")
def e7_multinomial(spark, sf_dir):
    cells = metrics.confusion(scored_entities(spark, sf_dir))
    return rounded(bootstrap.f1_interval(bootstrap.cell_bootstrap(cells, 1000)))


@query("e8_money_value", f"WITH {CELLS} SELECT *, 500*tp-50*fp-2000*fn AS total_value FROM cells")
def e8(spark, sf_dir):
    return metrics.money_value(metrics.confusion(scored_entities(spark, sf_dir)))


@query(
    "e11_model_ranking",
    f"WITH {CELLS}, m AS (SELECT model, ROUND({F1_SQL},6) AS f1, 500*tp-50*fp-2000*fn AS total_value FROM cells) "
    "SELECT *, (rank() OVER (ORDER BY f1 DESC, model))::INT AS rank_f1, (rank() OVER (ORDER BY total_value DESC, model))::INT AS rank_total_value FROM m",
)
def e11(spark, sf_dir):
    cells = metrics.confusion(scored_entities(spark, sf_dir))
    table = metrics.money_value(cells).select("model", metrics.summary_metrics()["f1"].alias("f1"), "total_value")
    return rounded(metrics.rank_models(table, ["f1", "total_value"]))


@query(
    "a18_best_model",
    f"WITH {CELLS}, m AS (SELECT model, ROUND({F1_SQL},6) AS f1 FROM cells) SELECT * FROM m ORDER BY f1 DESC, model LIMIT 1",
)
def a18_model(spark, sf_dir):
    cells = metrics.confusion(scored_entities(spark, sf_dir))
    return rounded(tables.best_row(metrics.weighted_metrics(cells).select("model", "f1"), "f1", "model"))


@query(
    "a19_fold_mean_and_deviation",
    f"WITH {SCORED}, f AS (SELECT model, {bucket_sql('entity_id', 5)} AS fold, AVG(CASE WHEN label=prediction THEN 1.0 ELSE 0.0 END) AS auc "
    "FROM scored GROUP BY 1,2) SELECT model, ROUND(AVG(auc),6) AS mean_auc, ROUND(STDDEV_POP(auc),6) AS std_auc, COUNT(*) AS folds "
    "FROM f GROUP BY model",
)
def a19(spark, sf_dir):
    """Per-fold accuracy of the fixed scorers, summarised as the tuning results are."""
    from tallyhawk.operators.models import fold_summary

    scored = scored_entities(spark, sf_dir).withColumn("fold", key_bucket("entity_id", 5))
    per_fold = scored.groupBy("model", "fold").agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("auc")
    )
    return rounded(fold_summary(per_fold, ["model"]))


@query(
    "e13_metric_ranges",
    f"WITH {CELLS}, m AS (SELECT {F1_SQL} AS f1, {ACCURACY_SQL} AS accuracy, 500*tp-50*fp-2000*fn AS total_value FROM cells) "
    "SELECT 'f1' AS metric, COUNT(*) FILTER (NOT f1 BETWEEN 0 AND 1) AS outside, COUNT(*) FILTER (NOT f1 BETWEEN 0 AND 1)=0 AS ok FROM m "
    "UNION ALL SELECT 'accuracy', COUNT(*) FILTER (NOT accuracy BETWEEN 0 AND 1), COUNT(*) FILTER (NOT accuracy BETWEEN 0 AND 1)=0 FROM m "
    "UNION ALL SELECT 'total_value', COUNT(*) FILTER (NOT total_value BETWEEN 0 AND 1), COUNT(*) FILTER (NOT total_value BETWEEN 0 AND 1)=0 FROM m",
)
def e13(spark, sf_dir):
    cells = metrics.confusion(scored_entities(spark, sf_dir))
    table = metrics.money_value(cells).withColumns(metrics.summary_metrics())
    return quality.metric_range_check(table, ["f1", "accuracy", "total_value"])


# Series relative to their first row: the value of orders per priority and year.

FIRST_YEAR = 1991
SERIES = (
    f"series AS (SELECT o_orderpriority AS type, (year(o_orderdate) - {FIRST_YEAR})::INT AS step, COUNT(*) AS \"rows\", "
    "ROUND(SUM(o_totalprice), 2) AS value FROM orders GROUP BY 1, 2)"
)


def yearly_value(spark, sf_dir):
    from tallyhawk.sources.readers import read_table

    step = (F.year("o_orderdate") - FIRST_YEAR).alias("step")
    grouped = read_table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("type"), step)
    return grouped.agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("value"))


@query("u2_scaling_runs", f"WITH {SERIES} SELECT type, step, \"rows\", ROUND(value,6) AS value FROM series")
def u2_runs(spark, sf_dir):
    return rounded(yearly_value(spark, sf_dir))


@query(
    "e12_scaling_table",
    f"WITH {SERIES}, f AS (SELECT *, FIRST_VALUE(value) OVER v AS t0, FIRST_VALUE(step) OVER v AS p0 FROM series "
    "WINDOW v AS (PARTITION BY type ORDER BY step)) "
    "SELECT type, step, \"rows\", ROUND(value,6) AS value, ROUND(t0/(step/p0::DOUBLE),6) AS ideal, "
    "ROUND(t0/value,6) AS speedup, ROUND(t0/value/(step/p0::DOUBLE),6) AS efficiency FROM f",
)
def e12(spark, sf_dir):
    return rounded(metrics.relative_to_first(yearly_value(spark, sf_dir), "type", "step", "value"))


@query(
    "w3_first_row_relation",
    f"WITH {SERIES} SELECT type, step, ROUND(FIRST_VALUE(value) OVER v / "
    "(step/(FIRST_VALUE(step) OVER v)::DOUBLE),6) AS ideal FROM series WINDOW v AS (PARTITION BY type ORDER BY step)",
)
def w3(spark, sf_dir):
    out = metrics.relative_to_first(yearly_value(spark, sf_dir), "type", "step", "value")
    return rounded(out.select("type", "step", "ideal"))


@query(
    "e10_performance_table",
    f"WITH {CELLS.replace(SCORED, CURVE)}, m AS (SELECT model, ROUND({F1_SQL},6) AS f1, ROUND({ACCURACY_SQL},6) AS accuracy, "
    f"ROUND({PRECISION_SQL},6) AS precision, ROUND({ACCURACY_SQL},6) AS recall FROM cells), "
    "a AS (SELECT model, ROUND(SUM(neg*(tp-pos/2.0))/(MAX(positives)*MAX(negatives)),6) AS auc_roc FROM curve GROUP BY model) "
    "SELECT * FROM m JOIN a USING (model)",
)
def e10(spark, sf_dir):
    from tallyhawk.operators.models import performance

    return rounded(performance(scored_entities(spark, sf_dir)))


@query(
    "e2_second_labelled_set",
    "WITH groups AS (SELECT n_chars AS score, SUM(toxic)::BIGINT AS pos, SUM(1-toxic)::BIGINT AS neg FROM documents JOIN labels USING (doc_id) GROUP BY 1), "
    "c AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp FROM groups) "
    "SELECT 'n_chars' AS model, ROUND(SUM(neg*(tp-pos/2.0))/(SUM(pos)*SUM(neg)),6) AS auc_roc, "
    "ROUND(SUM(pos*tp/(tp+fp)::DOUBLE)/SUM(pos),6) AS average_precision FROM c",
)
def e2_labels(spark, sf_dir):
    from tallyhawk.sources.readers import read_table

    documents = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    scored = documents.join(labels, "doc_id").select(
        F.lit("n_chars").alias("model"), F.col("n_chars").cast("double").alias("score"), "label"
    )
    return rounded(curves.curve_areas(scored))
