"""Queries over row-wise features, samples, splits, weights and per-column scaling."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tallyhawk.functions.hashing import HASH_SPACE, key_hash, poisson_one_cdf
from tallyhawk.operators import features, preprocessing, sampling
from tallyhawk.operators.prefix import rank_by_hash
from tallyhawk.operators.preprocessing import MedianImputer
from tallyhawk.plans.entities import COUNTS, GROUPS, PLAN, entities, labelled_splits
from tallyhawk.plans.queries_data import LINE_NUMBERS, gappy_lineitem
from tallyhawk.plans.registry import ENTITIES, GAPPY, below_sql, bucket_sql, hash_sql, query, rounded

SUMS = "n_click+n_view AS cat_engage, n_purchase+n_signup AS cat_convert, n_error AS cat_error"
SUMMED = ENTITIES + f", summed AS (SELECT *, {SUMS} FROM entities)"


@query("p3_group_sums", f"WITH {SUMMED} SELECT entity_id, cat_engage, cat_convert, cat_error FROM summed")
def p3(spark, sf_dir):
    stage = preprocessing.ColumnGroupSum(groups=GROUPS)
    return stage.transform(entities(spark, sf_dir)).select("entity_id", *GROUPS)


@query(
    "p4_guarded_ratio",
    f"WITH {SUMMED} SELECT entity_id, ROUND(CASE WHEN n_view > 0 THEN cat_error/n_view::DOUBLE ELSE 0 END, 6) AS ratio FROM summed",
)
def p4(spark, sf_dir):
    from tallyhawk.functions.scalars import guarded_ratio

    return rounded(entities(spark, sf_dir).select("entity_id", guarded_ratio("n_error", "n_view").alias("ratio")))


@query(
    "p5_logs",
    f"WITH {ENTITIES} SELECT entity_id, ROUND(ln(1+total_events),6) AS log_total_events, "
    "ROUND(ln(1+sum_value),6) AS log_sum_value FROM entities",
)
def p5(spark, sf_dir):
    logs = features.log_features(entities(spark, sf_dir), ["total_events", "sum_value"])
    return rounded(logs.select("entity_id", "log_total_events", "log_sum_value"))


@query(
    "p6_flags",
    f"WITH {ENTITIES} SELECT entity_id, CASE WHEN n_error > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS has_error, "
    "CASE WHEN sum_value > 100 THEN 1.0 ELSE 0.0 END::DOUBLE AS high_value FROM entities",
)
def p6(spark, sf_dir):
    flags = {"has_error": ("n_error", 0.0), "high_value": ("sum_value", 100.0)}
    return features.flag_features(entities(spark, sf_dir), flags).select("entity_id", *flags)


@query(
    "p7_zero_fill",
    f"WITH {GAPPY} SELECT l_linenumber, ROUND(SUM(CASE WHEN l_extendedprice IS NULL OR isnan(l_extendedprice) THEN 0 "
    "ELSE l_extendedprice END),2) AS total, COUNT(*) AS n FROM gappy GROUP BY l_linenumber",
)
def p7(spark, sf_dir):
    filled = features.zero_fill(gappy_lineitem(spark, sf_dir), LINE_NUMBERS)
    return filled.groupBy("l_linenumber").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("total"), F.count("l_extendedprice").alias("n")
    )


def _statistics_sql() -> str:
    columns = ", ".join(COUNTS)
    positive = "+".join(f"CASE WHEN {c}>0 THEN 1 ELSE 0 END" for c in COUNTS)
    mean = "total/5.0"
    squares = "+".join(f"({c}-{mean})*({c}-{mean})" for c in COUNTS)
    return (
        f"{ENTITIES}, s AS (SELECT *, ({'+'.join(COUNTS)})::DOUBLE AS total, greatest({columns})::DOUBLE AS hi, "
        f"least({columns})::DOUBLE AS lo, ({positive})::DOUBLE AS nz FROM entities), "
        "statistics AS (SELECT entity_id, total AS total_events, ROUND(total/5,6) AS mean_event_count, "
        f"ROUND(sqrt(({squares})/4),6) AS std_event_count, hi AS max_event_count, lo AS min_event_count, "
        "nz AS nonzero_events, ROUND(1-nz/5,6) AS event_sparsity, "
        "ROUND(CASE WHEN total>0 THEN hi/total ELSE 0 END,6) AS event_concentration, "
        "ROUND(CASE WHEN hi>0 THEN lo/hi ELSE 0 END,6) AS event_balance FROM s)"
    )


@query("p12_row_statistics", f"WITH {_statistics_sql()} SELECT * FROM statistics")
def p12(spark, sf_dir):
    out = features.row_statistics(entities(spark, sf_dir), COUNTS)
    return rounded(out.select("entity_id", *features.STATISTICS))


PAIRED = ["n_click", "n_error", "n_view"]


@query(
    "p13_pair_features",
    f"WITH {ENTITIES} SELECT entity_id, "
    + ", ".join(
        f"({a}*{b})::DOUBLE AS {a}_{b}_interaction, ROUND({a}/({b}+1)::DOUBLE,6) AS {a}_{b}_ratio"
        for a, b in combinations(PAIRED, 2)
    )
    + " FROM entities",
)
def p13(spark, sf_dir):
    out = features.pair_features(entities(spark, sf_dir), PAIRED)
    names = [c for c in out.columns if c.endswith(("_interaction", "_ratio"))]
    return rounded(out.select("entity_id", *names))


@query(
    "p14_power_features",
    f"WITH {ENTITIES} SELECT entity_id, "
    + ", ".join(
        f"({c}*{c})::DOUBLE AS {c}_squared, ({c}*{c}*{c})::DOUBLE AS {c}_cubed, ROUND(ln(1+{c}),6) AS {c}_log"
        for c in ("n_click", "n_error")
    )
    + " FROM entities",
)
def p14(spark, sf_dir):
    out = features.power_features(entities(spark, sf_dir), ["n_click", "n_error"])
    names = [c for c in out.columns if c.endswith(("_squared", "_cubed", "_log"))]
    return rounded(out.select("entity_id", *names))


@query(
    "p14_all_features",
    f"WITH {_statistics_sql()}, f AS (SELECT s.*, n_click+n_view AS e, n_error AS x, n_purchase+n_signup AS c "
    "FROM statistics s JOIN entities USING (entity_id)) "
    "SELECT entity_id, total_events, std_event_count, event_sparsity, "
    "ROUND(CASE WHEN total_events>0 THEN x/total_events ELSE 0 END,6) AS error_ratio, ROUND(ln(1+e),6) AS log_cat_engage, "
    "CASE WHEN x>0 THEN 1.0 ELSE 0.0 END::DOUBLE AS has_error, c AS cat_convert, "
    "CASE WHEN event_sparsity>0.7 THEN 1.0 ELSE 0.0 END::DOUBLE AS high_sparsity FROM f",
)
def p14_all(spark, sf_dir):
    out = features.engineer(entities(spark, sf_dir), PLAN)
    return rounded(
        out.select(
            "entity_id", "total_events", "std_event_count", "event_sparsity", "error_ratio",
            "log_cat_engage", "has_error", "cat_convert", "high_sparsity",
        )
    )


def feature_table_sql() -> str:
    """``features``: all features of the plan in order, ``every``: all rows as (entity_id, name, x), and ``long``: the training rows among them."""
    pairs = ", ".join(
        f"({a}*{b})::DOUBLE AS {a}_{b}_interaction, {a}/({b}+1)::DOUBLE AS {a}_{b}_ratio" for a, b in combinations(PAIRED, 2)
    )
    powers = ", ".join(
        f"({c}*{c})::DOUBLE AS {c}_squared, ({c}*{c}*{c})::DOUBLE AS {c}_cubed, ln(1+{c}) AS {c}_log" for c in PLAN.powers
    )
    exact = ENTITIES + _statistics_sql().removeprefix(ENTITIES).replace("ROUND(", "(").replace(",6)", ")")
    counts = ", ".join(f"e.{c}::DOUBLE AS {c}" for c in COUNTS)
    sums = ", ".join(f"({'+'.join('e.' + c for c in members)})::DOUBLE AS {name}" for name, members in GROUPS.items())
    return (
        f"{exact}, wide AS (SELECT e.entity_id, {counts}, s.* EXCLUDE (entity_id), {sums}, e.sum_value "
        "FROM entities e JOIN statistics s USING (entity_id)), "
        "features AS (SELECT *, CASE WHEN total_events>0 THEN cat_error/total_events ELSE 0 END AS error_ratio, "
        "ln(1+total_events) AS log_total_events, ln(1+cat_engage) AS log_cat_engage, ln(1+cat_error) AS log_cat_error, "
        "CASE WHEN cat_error>0 THEN 1.0 ELSE 0.0 END::DOUBLE AS has_error, "
        f"CASE WHEN event_sparsity>0.7 THEN 1.0 ELSE 0.0 END::DOUBLE AS high_sparsity, {pairs}, {powers} FROM wide), "
        f"every AS (SELECT entity_id, name, x FROM features UNPIVOT (x FOR name IN ({', '.join(PLAN.names)}))), "
        f"long AS (SELECT * FROM every WHERE {below_sql('entity_id', 'split', 0.6)}), "
        f"places AS (SELECT UNNEST({PLAN.names!r}) AS name, UNNEST(range({len(PLAN.names)}))::INT AS idx)"
    )


# Samples, splits, weights


@query("m4_bernoulli_sample", f"WITH {ENTITIES} SELECT entity_id, label FROM entities WHERE {below_sql('entity_id', 'sample', 0.02)}")
def m4(spark, sf_dir):
    return sampling.bernoulli_sample(entities(spark, sf_dir), "entity_id", 0.02).select("entity_id", "label")


def ranked_sql(purpose: str) -> str:
    return (
        f"{ENTITIES}, ranked AS (SELECT entity_id, label, "
        f"row_number() OVER (PARTITION BY label ORDER BY {hash_sql('entity_id', purpose)}, entity_id) AS rn, "
        "COUNT(*) OVER (PARTITION BY label) AS n FROM entities)"
    )


@query("m5_stratified_sample", f"WITH {ranked_sql('sample')} SELECT entity_id, label FROM ranked WHERE rn <= ceil(n*0.1)")
def m5(spark, sf_dir):
    base = entities(spark, sf_dir).select("entity_id", "label")
    return sampling.stratified_sample(base, "entity_id", "label", 0.1)


@query("m5_hash_ranks", f"WITH {ranked_sql('sample')} SELECT entity_id, label, rn AS rank, n AS stratum_rows FROM ranked")
def m5_ranks(spark, sf_dir):
    base = entities(spark, sf_dir).select("entity_id", "label")
    return rank_by_hash(base, ["label"], key_hash("entity_id", "sample"), "entity_id")


@query(
    "m6_fraction_ladder",
    f"WITH {ENTITIES}, f AS (SELECT UNNEST([0.1,0.2,0.4,0.6,0.8,1.0])::DOUBLE AS frac) "
    "SELECT frac, label, COUNT(*) AS n FROM entities JOIN f ON "
    f"{hash_sql('entity_id', 'sample')} < CAST(frac*{HASH_SPACE}::DOUBLE AS BIGINT) GROUP BY frac, label",
)
def m6(spark, sf_dir):
    ladder = sampling.fraction_ladder(entities(spark, sf_dir).select("entity_id", "label"), "entity_id")
    return ladder.groupBy("frac", "label").agg(F.count(F.lit(1)).alias("n"))


SPLIT = (
    f"{ENTITIES}, parts AS (SELECT entity_id, label, CASE WHEN {below_sql('entity_id', 'split', 0.6)} THEN 'train' "
    f"WHEN {below_sql('entity_id', 'split', 0.8)} THEN 'val' ELSE 'test' END AS split FROM entities)"
)


@query("m7_three_way_split", f"WITH {SPLIT} SELECT entity_id, label, split FROM parts")
def m7(spark, sf_dir):
    return labelled_splits(spark, sf_dir).select("entity_id", "label", "split")


@query(
    "m8_split_audit",
    f"WITH {SPLIT}, t AS (SELECT split, COUNT(*) AS split_rows FROM parts GROUP BY split) "
    "SELECT split, label, COUNT(*) AS n, ANY_VALUE(split_rows) AS split_rows, "
    "ROUND(COUNT(*)/ANY_VALUE(split_rows)::DOUBLE*100,4) AS pct_of_split, "
    "ROUND(ANY_VALUE(split_rows)/(SELECT COUNT(*) FROM parts)::DOUBLE*100,4) AS pct_of_all "
    "FROM parts JOIN t USING (split) GROUP BY split, label",
)
def m8(spark, sf_dir):
    return sampling.split_audit(labelled_splits(spark, sf_dir))


@query(
    "m9_oversampled",
    f"WITH {ENTITIES}, f AS (SELECT CASE WHEN COUNT(*) FILTER (label=1) > 0 AND COUNT(*) FILTER (label=0) > 2*COUNT(*) FILTER (label=1) "
    "THEN floor(COUNT(*) FILTER (label=0)/(COUNT(*) FILTER (label=1))::DOUBLE)::INT ELSE 1 END AS factor FROM entities) "
    "SELECT label, SUM(CASE WHEN label=1 THEN factor ELSE 1 END)::BIGINT AS n, COUNT(*) AS distinct_ids FROM entities, f GROUP BY label",
)
def m9(spark, sf_dir):
    out = sampling.oversample_minority(entities(spark, sf_dir).select("entity_id", "label"))
    return out.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("copy") == 1).alias("distinct_ids")
    )


@query(
    "m10_class_weights",
    f"WITH {ENTITIES}, c AS (SELECT label, COUNT(*) AS nc, (SELECT COUNT(*) FROM entities) AS n FROM entities GROUP BY label) "
    "SELECT entity_id, label, ROUND(n/(2.0*nc),6) AS class_weight FROM entities JOIN c USING (label)",
)
def m10(spark, sf_dir):
    return rounded(sampling.class_weights(entities(spark, sf_dir).select("entity_id", "label")))


@query("m11_stratified_folds", f"WITH {ranked_sql('fold')} SELECT entity_id, label, ((rn-1)%5)::INT AS fold FROM ranked")
def m11(spark, sf_dir):
    base = entities(spark, sf_dir).select("entity_id", "label")
    return sampling.stratified_folds(base, "entity_id", "label", 5)


@query(
    "m11_hash_folds",
    f"WITH {ENTITIES} SELECT entity_id, label, {bucket_sql('entity_id', 3, 'fold')}::INT AS fold FROM entities",
)
def m11_hash(spark, sf_dir):
    return sampling.hash_folds(entities(spark, sf_dir).select("entity_id", "label"), "entity_id", 3)


POISSON = (
    "CASE " + " ".join(f"WHEN u<{bound!r}::DOUBLE THEN {n}" for n, bound in enumerate(poisson_one_cdf()))
    + f" ELSE {len(poisson_one_cdf())} END"
)


def poisson_sql(source: str, replicates: int) -> str:
    """``drawn``: each source row with its Poisson(1) weight per replicate."""
    key = "entity_id || '-' || replicate"
    return (
        f"drawn AS (SELECT *, {POISSON} AS weight FROM (SELECT *, {hash_sql(key)}/{HASH_SPACE}::DOUBLE AS u "
        f"FROM {source}, (SELECT UNNEST(range({replicates}))::INT AS replicate)))"
    )


@query(
    "m12_bootstrap_weights",
    f"WITH {ENTITIES}, {poisson_sql('entities', 20)} SELECT replicate, label, SUM(weight)::BIGINT AS weight, "
    "COUNT(*) AS drawn_rows FROM drawn WHERE weight > 0 GROUP BY replicate, label",
)
def m12(spark, sf_dir):
    drawn = sampling.bootstrap_weights(entities(spark, sf_dir).select("entity_id", "label"), "entity_id", 20)
    return drawn.groupBy("replicate", "label").agg(
        F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("drawn_rows")
    )


# Imputation and scaling


@query(
    "f1_median_imputed",
    f"WITH {GAPPY}, m AS (SELECT quantile_disc(l_extendedprice,0.5) FILTER (NOT isnan(l_extendedprice)) AS med FROM gappy) "
    "SELECT l_linenumber, COUNT(*) AS n, ROUND(SUM(CASE WHEN l_extendedprice IS NULL OR isnan(l_extendedprice) THEN med "
    "ELSE l_extendedprice END),2) AS total FROM gappy, m GROUP BY l_linenumber",
)
def f1(spark, sf_dir):
    gappy = gappy_lineitem(spark, sf_dir).select("l_linenumber", "l_extendedprice", "l_quantity")
    fitted = MedianImputer(columns=["l_extendedprice", "l_quantity"]).fit(gappy)
    return fitted.transform(gappy).groupBy("l_linenumber").agg(
        F.count("l_extendedprice").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total")
    )


SCALED = ["n_click", "n_error", "sum_value"]


@query(
    "f3_standard_scores",
    f"WITH {ENTITIES}, k AS (SELECT {', '.join(f'AVG({c}) AS m_{c}, STDDEV_SAMP({c}) AS s_{c}' for c in SCALED)} FROM entities) "
    f"SELECT entity_id, {', '.join(f'ROUND(({c}-m_{c})/s_{c},6)+0.0 AS {c}_std' for c in SCALED)} FROM entities, k",
)
def f3(spark, sf_dir):
    out = preprocessing.standard_scores(entities(spark, sf_dir), SCALED)
    return rounded(out.select("entity_id", *[f"{c}_std" for c in SCALED]))


@query(
    "f4_min_max_scores",
    f"WITH {ENTITIES}, k AS (SELECT {', '.join(f'MIN({c}) AS a_{c}, MAX({c}) AS z_{c}' for c in SCALED)} FROM entities) "
    f"SELECT entity_id, {', '.join(f'ROUND(({c}-a_{c})/(z_{c}-a_{c})::DOUBLE,6)+0.0 AS {c}_mm' for c in SCALED)} FROM entities, k",
)
def f4(spark, sf_dir):
    out = preprocessing.min_max_scores(entities(spark, sf_dir), SCALED)
    return rounded(out.select("entity_id", *[f"{c}_mm" for c in SCALED]))


@query(
    "f5_covariances",
    f"WITH {ENTITIES} "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, ROUND(COVAR_SAMP({x},{y}),6) AS cov FROM entities"
        for i, x in enumerate([*COUNTS, "sum_value"])
        for y in [*COUNTS, "sum_value"][i:]
    ),
)
def f5_covariances(spark, sf_dir):
    return rounded(preprocessing.covariances(entities(spark, sf_dir), [*COUNTS, "sum_value"]))
