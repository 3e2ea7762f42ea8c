"""ROC and precision-recall curves, their areas, and thinning, for any number of scored rows.

Scores are first collapsed to one row per (model, score), which also settles ties, and then given
running counts over a global order without a single-task window (see ``prefix``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhawk.operators.prefix import BUCKET, quantile_bucket, running_totals


def score_groups(scored: DataFrame, by: str = "model") -> DataFrame:
    """(by, score, pos, neg): label counts per distinct score, combined map-side."""
    return scored.groupBy(by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )


def threshold_counts(scored: DataFrame, by: str = "model") -> DataFrame:
    """Per distinct score, highest first: its counts, running tp and fp, class totals, place and places.

    ``place`` numbers the thresholds of a model from 1; ``places`` is how many there are.
    """
    groups = quantile_bucket(score_groups(scored, by), "score", ["pos", "neg"]).withColumn("one", F.lit(1).cast("bigint"))
    totals = running_totals(groups, [by], [F.desc("score")], ["pos", "neg", "one"], descending=True)
    return totals.select(
        by,
        "score",
        "pos",
        "neg",
        F.col("run_pos").alias("tp"),
        F.col("run_neg").alias("fp"),
        F.col("tot_pos").alias("positives"),
        F.col("tot_neg").alias("negatives"),
        F.col("run_one").alias("place"),
        F.col("tot_one").alias("places"),
        BUCKET,
    )


def curve_areas(scored: DataFrame, by: str = "model") -> DataFrame:
    """(by, auc_roc, average_precision), exact, ties averaged; null where a class is missing.

    Average precision is the sum of precision times recall gained per threshold, not a trapezoid.
    """
    return areas_of(threshold_counts(scored, by), by)


def areas_of(counts: DataFrame, by: str = "model") -> DataFrame:
    """The areas from ``threshold_counts``."""
    pairs = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    gained = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    positives, negatives = F.max("positives"), F.max("negatives")
    return counts.groupBy(by).agg(
        F.try_divide(pairs, positives.cast("double") * negatives).alias("auc_roc"),
        F.try_divide(gained, positives.cast("double")).alias("average_precision"),
    )


def roc_points(scored: DataFrame, every: int = 1, drop_collinear: bool = False, by: str = "model") -> DataFrame:
    """(by, place, threshold, fpr, tpr), highest threshold first, after a (0, 0) point of place 0.

    ``every`` keeps each n-th point and always the last. ``drop_collinear`` first leaves out points
    in the middle of a straight run, where the counts repeat those of the next threshold.
    """
    return roc_of(threshold_counts(scored, by), every, drop_collinear, by)


def roc_of(counts: DataFrame, every: int = 1, drop_collinear: bool = False, by: str = "model") -> DataFrame:
    """The same from ``threshold_counts``."""
    if drop_collinear:
        counts = _corners(counts, by)
    wanted = (F.col("place") % every == 0) | (F.col("place") == F.col("places"))
    point = _point(
        F.col("place"),
        F.col("score"),
        fpr=F.try_divide(F.col("fp"), F.col("negatives")),
        tpr=F.try_divide(F.col("tp"), F.col("positives")),
    )
    origin = _point(F.lit(0), F.lit(float("inf")), fpr=F.lit(0.0), tpr=F.lit(0.0))
    return _emit(counts, by, [(F.col("place") == 1, origin), (wanted, point)])


def _point(place: Column, threshold: Column, **values: Column) -> Column:
    named = [value.cast("double").alias(name) for name, value in values.items()]
    return F.struct(place.cast("bigint").alias("place"), threshold.cast("double").alias("threshold"), *named)


def _emit(counts: DataFrame, by: str, points: list[tuple[Column, Column]]) -> DataFrame:
    """The points whose condition a row meets. A union of two branches would read the data twice."""
    candidates = F.array(*[F.when(condition, point) for condition, point in points])
    return counts.select(by, F.explode(F.array_compact(candidates)).alias("_p")).select(by, "_p.*")


def _corners(counts: DataFrame, by: str) -> DataFrame:
    """The first threshold, those where the curve bends, and the last; renumbered.

    A point lies inside a straight run when the next threshold adds the very same counts. The next
    threshold of a bucket's last row is the first of the next bucket that has rows.
    """
    step = F.struct("pos", "neg")
    along = Window.partitionBy(by, BUCKET).orderBy(F.desc("score"))
    rows = counts.withColumn("next", F.lead(step).over(along))
    heads = counts.groupBy(by, BUCKET).agg(F.max_by(step, "score").alias("head"))
    following = Window.partitionBy(by).orderBy(F.desc(BUCKET))
    heads = heads.select(by, BUCKET, F.lead("head").over(following).alias("after"))
    rows = rows.join(heads, [by, BUCKET]).withColumn("next", F.coalesce("next", "after"))
    same = (F.col("next.pos") == F.col("pos")) & (F.col("next.neg") == F.col("neg"))
    bends = rows.filter((F.col("place") == 1) | ~F.coalesce(same, F.lit(False)))
    bends = bends.drop("place", "places", "next", "after").withColumn("one", F.lit(1).cast("bigint"))
    again = running_totals(bends, [by], [F.desc("score")], ["one"], descending=True)
    return again.withColumnsRenamed({"run_one": "place", "tot_one": "places"}).drop("one")


def pr_points(scored: DataFrame, every: int = 1, by: str = "model") -> DataFrame:
    """(by, place, threshold, precision, recall), lowest threshold (place 0) first.

    The final point, beyond the highest threshold, is precision 1 at recall 0. ``every`` keeps each
    n-th point and always the final one.
    """
    return pr_of(threshold_counts(scored, by), every, by)


def pr_of(counts: DataFrame, every: int = 1, by: str = "model") -> DataFrame:
    """The same from ``threshold_counts``."""
    at = F.col("places") - F.col("place")
    point = _point(
        at,
        F.col("score"),
        precision=F.col("tp") / (F.col("tp") + F.col("fp")),
        recall=F.try_divide(F.col("tp"), F.col("positives")),
    )
    end = _point(F.col("places"), F.lit(None), precision=F.lit(1.0), recall=F.lit(0.0))
    return _emit(counts, by, [(F.col("place") == 1, end), (at % every == 0, point)])


def with_area(points: DataFrame, areas: DataFrame, area: str, by: str = "model") -> DataFrame:
    """Attach a model's area to each of its (thinned) curve points."""
    return points.join(areas.select(by, area), by)
