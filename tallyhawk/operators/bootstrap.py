"""Bootstrap confidence intervals of metrics that depend on the confusion cells only.

Drawing n rows with replacement makes the four cells multinomial with n trials and the observed cell
shares. Drawing the cells directly is therefore the same bootstrap, at a cost of models x replicates.

The Poisson bootstrap gives each row a Poisson(1) weight. Rows that no metric tells apart may be counted first: the sum of n such weights is
Poisson(n). ``stratum_bootstrap`` draws that sum from hashes, so that any engine with MD5 gets the same numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyhawk.functions.hashing import key_bucket, poisson_cdf, unit_hash
from tallyhawk.operators.metrics import CELLS, weighted_confusion, summary_metrics
from tallyhawk.operators.sampling import bootstrap_weights

STRATA = 8
DIGITS = 8


def cell_bootstrap(cells: DataFrame, replicates: int = 1000, seed: int = 42, by: str = "model") -> DataFrame:
    """(by, replicate, tp, fp, fn, tn): one multinomial draw per model and replicate."""
    spread = cells.select(by, *CELLS, F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = batch[list(CELLS)].to_numpy(dtype=np.int64)
            for i, replicate in enumerate(batch["replicate"]):
                n = counts[i].sum()
                if n:
                    counts[i] = np.random.default_rng([seed, int(replicate)]).multinomial(n, counts[i] / n)
            yield batch.assign(**{cell: counts[:, j] for j, cell in enumerate(CELLS)})

    schema = spread.schema
    return spread.mapInPandas(draw, schema)


def row_bootstrap(scored: DataFrame, key: str, replicates: int, by: str = "model") -> DataFrame:
    """The same table from Poisson row weights: reproducible from keys alone, at rows x replicates cost."""
    drawn = bootstrap_weights(scored.select(by, key, "label", "prediction"), key, replicates)
    return weighted_confusion(drawn, "weight", [by, "replicate"])


def stratum_counts(scored: DataFrame, key: str, strata: int = STRATA, by: str = "model") -> DataFrame:
    """(by, cell, stratum, n): rows per confusion cell and hash stratum of the row key; a cell is '<label><prediction>'."""
    cell = F.concat(F.col("label").cast("string"), F.col("prediction").cast("string"))
    return scored.groupBy(by, cell.alias("cell"), key_bucket(key, strata, "stratum").cast("int").alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


CELL_CODES = {"tp": "11", "fp": "01", "fn": "10", "tn": "00"}


def stratum_cells(counts: DataFrame, by: str = "model") -> DataFrame:
    """(by, tp, fp, fn, tn): the confusion cells again, from ``stratum_counts``."""
    return counts.groupBy(by).agg(*_cell_sums("n"))


def _cell_sums(value: str) -> list[Column]:
    return [F.coalesce(F.sum(F.when(F.col("cell") == code, F.col(value))), F.lit(0)).alias(name) for name, code in CELL_CODES.items()]


def stratum_bootstrap(counts: DataFrame, replicates: int = 1000, by: str = "model") -> DataFrame:
    """(by, replicate, tp, fp, fn, tn) from ``stratum_counts``: a Poisson(n) draw per count and replicate, whatever n is.

    A count is a sum of powers of two, and Poisson draws add up, so below 256 each binary digit is drawn by inversion of its own
    distribution. What is left is a multiple of 256 and drawn as the normal quantile with the skewness term, whose
    distribution function differs from Poisson's by less than 0.001. Draws take their uniform numbers from a hash
    of model, cell, stratum, digit and replicate.
    """
    spark = counts.sparkSession
    tables = spark.createDataFrame([(b, poisson_cdf(1 << b)) for b in range(DIGITS)], "digit int, below array<double>")
    high = F.col("n") - F.col("n") % (1 << DIGITS)
    digits = F.array(*[F.when(F.shiftright("n", b) % 2 == 1, F.lit(b)) for b in range(DIGITS)], F.when(high > 0, F.lit(DIGITS)))
    drawn = counts.withColumn("high", high).withColumn("digit", F.explode(digits)).filter(F.col("digit").isNotNull())
    drawn = drawn.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    name = F.concat_ws("|", by, "cell", F.col("stratum"), F.col("digit"))
    drawn = drawn.withColumns({"u": unit_hash(name, F.col("replicate")), "v": unit_hash(name, F.concat(F.lit("v"), F.col("replicate")))})
    drawn = drawn.join(tables, "digit", "left")
    small = F.size(F.filter("below", lambda bound: bound <= F.col("u")))
    z = F.sqrt(-2 * F.log(1 - F.col("u"))) * F.cos(2 * pi * F.col("v"))
    large = F.greatest(F.lit(0), F.floor(F.col("high") + F.sqrt("high") * z + (z * z - 1) / 6 + 0.5))
    drawn = drawn.withColumn("weight", F.when(F.col("digit") < DIGITS, small).otherwise(large).cast("bigint"))
    return drawn.groupBy(by, "replicate").agg(*_cell_sums("weight"))


def f1_interval(replicates: DataFrame, alpha: float = 0.05, by: str = "model") -> DataFrame:
    """(by, mean_f1, ci_lower, ci_upper): percentile interval over replicates, linear between ranks.

    A model has as many rows here as there are replicates, so the built-in exact percentile is bounded.
    """
    scores = replicates.select(by, summary_metrics()["f1"].alias("f1"))
    ends = F.percentile("f1", F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))
    return scores.groupBy(by).agg(F.avg("f1").alias("mean_f1"), ends.alias("_ci")).select(
        by, "mean_f1", F.col("_ci")[0].alias("ci_lower"), F.col("_ci")[1].alias("ci_upper")
    )
