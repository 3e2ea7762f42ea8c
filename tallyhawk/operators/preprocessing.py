"""Preprocessing stages for ``pyspark.ml`` pipelines; all of them save and load."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import MinMaxScaler, PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window, functions as F

from tallyhawk.functions.rows import melt
from tallyhawk.functions.scalars import is_missing
from tallyhawk.operators import features
from tallyhawk.operators.features import FeaturePlan
from tallyhawk.operators.quantiles import exact_quantiles
from tallyhawk.session import cached


class ColumnGroupSum(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds one sum column per named group of input columns."""

    groups = Param(Params._dummy(), "groups", "map from new column to the columns it sums")

    @keyword_only
    def __init__(self, *, groups: dict[str, list[str]] | None = None) -> None:
        super().__init__()
        if groups is not None:
            self._set(groups=groups)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return features.group_sums(dataset, self.getOrDefault(self.groups))


class RowFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the row-wise features of a plan, except the group sums."""

    plan = Param(Params._dummy(), "plan", "fields of a feature plan")

    @keyword_only
    def __init__(self, *, plan: dict | None = None) -> None:
        super().__init__()
        if plan is not None:
            self._set(plan=plan)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fields = dict(self.getOrDefault(self.plan))
        return features.engineer(dataset, FeaturePlan(**{**fields, "groups": {}}))


class ZeroFill(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Null or NaN becomes 0."""

    columns = Param(Params._dummy(), "columns", "columns to fill", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None) -> None:
        super().__init__()
        if columns is not None:
            self._set(columns=columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return features.zero_fill(dataset, self.getOrDefault(self.columns))


class MedianImputer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Exact (lower) median per column, found by distributed rank selection."""

    columns = Param(Params._dummy(), "columns", "columns to impute in place", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None) -> None:
        super().__init__()
        if columns is not None:
            self._set(columns=columns)

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        columns = self.getOrDefault(self.columns)
        # At most one row per column.
        rows = exact_quantiles(dataset, columns, [0.5], method="lower").collect()
        medians = {row["feature"]: row["q"] for row in rows}
        empty = [c for c in columns if c not in medians]
        if empty:
            raise ValueError(f"no values to take a median of: {', '.join(empty)}")
        return MedianImputerModel(columns=columns, medians=[medians[c] for c in columns])


class MedianImputerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    columns = Param(Params._dummy(), "columns", "columns to impute in place", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "fill value per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None, medians: list[float] | None = None) -> None:
        super().__init__()
        if columns is not None:
            self._set(columns=columns, medians=medians)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = zip(self.getOrDefault(self.columns), self.getOrDefault(self.medians))
        return dataset.withColumns(
            {
                c: F.when(is_missing(F.col(c).cast("double")), F.lit(m)).otherwise(F.col(c).cast("double"))
                for c, m in pairs
            }
        )


def row_stages(
    plan: FeaturePlan, invalid: str = "error"
) -> list[Estimator | Transformer]:
    """Impute, engineer, zero-fill and assemble into ``raw_features``.

    Zero-filling leaves nothing invalid to assemble. ``invalid="skip"`` therefore drops no row either, but
    its filter on all features is pushed towards the scan and computes every feature a second time.
    """
    fields = {name: getattr(plan, name) for name in plan.__dataclass_fields__}
    return [
        MedianImputer(columns=plan.imputed),
        ColumnGroupSum(groups=plan.groups),
        RowFeatures(plan=fields),
        ZeroFill(columns=plan.names),
        VectorAssembler(inputCols=plan.names, outputCol="raw_features", handleInvalid=invalid),
    ]


def vector_stages(components: int | None = 20) -> list[Estimator]:
    """Standardise, min-max scale and (optionally) project ``raw_features``."""
    stages: list[Estimator] = [
        StandardScaler(inputCol="raw_features", outputCol="std_features", withMean=True, withStd=True),
        MinMaxScaler(inputCol="raw_features", outputCol="mm_features"),
    ]
    if components:
        stages.append(PCA(k=components, inputCol="std_features", outputCol="pca_features"))
    return stages


def fit_preprocessing(
    train: DataFrame, plan: FeaturePlan, components: int | None = 20
) -> PipelineModel:
    """Fit on the training split only, so nothing of the other splits leaks into medians or scales.

    Only the columns of the plan are read. The assembled vectors are cached while the vector stages make
    their passes, so rows are prepared twice in all (medians, vectors) and not once per stage.
    """
    used = train.select(*_inputs(train, plan))
    rows = Pipeline(stages=row_stages(plan)).fit(used)
    with cached(rows.transform(used).select("raw_features")) as vectors:
        scaled = Pipeline(stages=vector_stages(components)).fit(vectors)
    return PipelineModel(stages=[*rows.stages, *scaled.stages])


def _inputs(df: DataFrame, plan: FeaturePlan) -> list[str]:
    sources = {*plan.imputed, *plan.pairs_given}
    return [c for c in df.columns if c in sources]


def feature_registry(df: DataFrame, vector: str) -> DataFrame:
    """(idx, feature) from the metadata that assembling left on a vector column."""
    attributes = df.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
    rows = sorted((a["idx"], a["name"]) for kind in attributes.values() for a in kind)
    return df.sparkSession.createDataFrame(rows, "idx int, feature string")


def vector_summary(df: DataFrame, vector: str) -> DataFrame:
    """(idx, n, mean, variance, nonzeros) of every place of a vector column, by the library's one-pass summariser."""
    wanted = Summarizer.metrics("count", "mean", "variance", "numNonZeros").summary(F.col(vector)).alias("_s")
    one = df.select(wanted).select("_s.count", *[vector_to_array(f"_s.{c}").alias(c) for c in ("mean", "variance", "numNonZeros")])
    places = F.posexplode(F.arrays_zip("mean", "variance", "numNonZeros")).alias("idx", "_p")
    return one.select("count", places).select(
        "idx", F.col("count").alias("n"), "_p.mean", "_p.variance", F.col("_p.numNonZeros").cast("bigint").alias("nonzeros")
    )


def described_registry(df: DataFrame, vector: str) -> DataFrame:
    """The feature registry with each feature's count, mean, variance and rows other than zero."""
    return feature_registry(df, vector).join(vector_summary(df, vector), "idx")


def scaled_columns(df: DataFrame, vector: str, key: str) -> DataFrame:
    """(key, idx, value): a vector column in long form."""
    return df.select(key, F.posexplode(vector_to_array(vector)).alias("idx", "value"))


def standard_scores(df: DataFrame, cols: list[str]) -> DataFrame:
    """``<c>_std``: (x - mean) / sample deviation; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
            *[F.stddev_samp(c).alias(f"s_{i}") for i, c in enumerate(cols)],
        )
    ).scalar()
    new = {}
    for i, c in enumerate(cols):
        spread = stats.getField(f"s_{i}")
        score = (F.col(c) - stats.getField(f"m_{i}")) / spread
        new[f"{c}_std"] = F.when(spread > 0, score).otherwise(F.lit(0.0))
    return df.withColumns(new)


def min_max_scores(df: DataFrame, cols: list[str]) -> DataFrame:
    """``<c>_mm``: scaled to [0, 1]; a constant column becomes 0.5."""
    stats = df.agg(
        F.struct(
            *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(cols)],
            *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(cols)],
        )
    ).scalar()
    new = {}
    for i, c in enumerate(cols):
        low, high = stats.getField(f"lo_{i}"), stats.getField(f"hi_{i}")
        new[f"{c}_mm"] = F.when(high > low, (F.col(c) - low) / (high - low)).otherwise(F.lit(0.5))
    return df.withColumns(new)


def covariances(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x, y, cov): sample covariance of each pair, in one pass; what the projection is computed from."""
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i:]]
    wide = df.agg(*[F.covar_samp(x, y).alias(f"v_{i}") for i, (x, y) in enumerate(pairs)])
    return melt(wide, [{"x": F.lit(x), "y": F.lit(y), "cov": F.col(f"v_{i}")} for i, (x, y) in enumerate(pairs)])


def explained_variance(fitted: PipelineModel, df: DataFrame, enough: float = 0.95) -> DataFrame:
    """(component, variance, cumulative, within): share per component and whether it is needed for ``enough``."""
    shares = fitted.stages[-1].explainedVariance.toArray()
    rows = [(i, float(v)) for i, v in enumerate(shares, 1)]
    table = df.sparkSession.createDataFrame(rows, "component int, variance double")
    # One row per component, a number the caller fixed.
    along = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulative = F.sum("variance").over(along)
    return table.withColumn("cumulative", cumulative).withColumn(
        "within", F.col("cumulative") - F.col("variance") < enough
    )
