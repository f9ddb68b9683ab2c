"""Global regressor over all series: training, scoring, importance, horizon."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.constants import (
    HIERARCHY_COLS,
    HORIZON_DAYS,
    LEARNING_RATE,
    MIN_ROWS_PER_LEAF,
    N_TREES,
    NON_FEATURE_COLS,
    SAMPLE_FRACTION,
    SEED,
    SERIES_COLS,
    TREE_DEPTH,
    TWEEDIE_POWER,
)
from stratacast.functions.columns import clip_at_zero, round_cents
from stratacast.session import broadcast_if_small
from stratacast.sources.tables import path_exists, write_predictions

CATEGORICAL = list(HIERARCHY_COLS)


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs: every column but ids, dates, texts and the target."""
    return [c for c in df.columns if c not in NON_FEATURE_COLS]


def prepare_features(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and categorical input names."""
    names = feature_columns(df)
    return [c for c in names if c not in CATEGORICAL], [c for c in names if c in CATEGORICAL]


def target_means(train: DataFrame, categories: Sequence[str], target: str = "sales") -> DataFrame:
    """Mean target per value of each categorical column, in one aggregate.

    A table instead of an indexer: the list of items grows with the data and
    would have to live on the driver.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in categories])
    return (
        train.select(F.col(target).alias("_t"), F.inline(pairs))
        .groupBy("column_name", "value")
        .agg(F.avg("_t").alias("mean_target"))
    )


def encode(df: DataFrame, means: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Add ``<column>_enc``; a value never seen in training gets the mean of its column."""
    fallback = means.groupBy("column_name").agg(F.avg("mean_target").alias("m"))
    fallback = {r["column_name"]: r["m"] for r in fallback.collect()}  # one row per column
    for c in categories:
        one = means.where(F.col("column_name") == c).select(F.col("value").alias(c), F.col("mean_target").alias("_m"))
        df = df.join(broadcast_if_small(one), c, "left")
        df = df.withColumn(f"{c}_enc", F.coalesce("_m", F.lit(fallback.get(c, 0.0)))).drop("_m")
    return df


@dataclass
class DemandModel:
    """A fitted pipeline with the encodings it was trained on, and the spread of each input."""

    pipeline: PipelineModel
    means: DataFrame
    numeric: list[str]
    categories: list[str]
    spreads: list[float]

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *[f"{c}_enc" for c in self.categories]]

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``pred``, never negative; the frame keeps its own columns, a ``pred`` among them is replaced."""
        keep = [c for c in df.columns if c != "pred"]
        stages = self.pipeline.transform(encode(with_inputs(df, self.numeric), self.means, self.categories))
        return stages.select(*keep, clip_at_zero(F.col("prediction")).alias("pred"))

    def feature_importance(self) -> DataFrame:
        """Gain importance of trees; for the linear model, what one standard deviation of an input moves.

        A bare coefficient would depend on the unit of its input.
        """
        last = self.pipeline.stages[-1]
        spark = self.means.sparkSession
        if hasattr(last, "featureImportances"):
            weights = list(last.featureImportances.toArray())
        else:
            weights = [w * s for w, s in zip(last.coefficients.toArray(), self.spreads, strict=True)]
        rows = [(n, abs(float(w))) for n, w in zip(self.inputs, weights, strict=True)]
        return spark.createDataFrame(rows, "feature string, importance double")

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        self.means.write.mode("overwrite").parquet(f"{path}/means")
        spark = self.means.sparkSession
        names = [*[("numeric", c) for c in self.numeric], *[("category", c) for c in self.categories]]
        rows = [(kind, i, c, s) for i, ((kind, c), s) in enumerate(zip(names, self.spreads, strict=True))]
        kinds = "kind string, position int, name string, spread double"
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/inputs")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DemandModel:
        rows = spark.read.parquet(f"{path}/inputs").orderBy("position").collect()
        return cls(
            PipelineModel.load(f"{path}/pipeline"),
            spark.read.parquet(f"{path}/means"),
            [r["name"] for r in rows if r["kind"] == "numeric"],
            [r["name"] for r in rows if r["kind"] == "category"],
            [r["spread"] for r in rows],
        )


def with_inputs(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Inputs under their own names with an ``_in`` suffix, so nothing is overwritten."""
    cells = {
        f"{c}_in": F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)
        for c in numeric
    }
    return df.withColumns(cells)


def linear_stage(max_iter: int = 25) -> GeneralizedLinearRegression:
    """Tweedie loss with a log link; regularised because the inputs overlap."""
    return GeneralizedLinearRegression(
        family="tweedie",
        variancePower=TWEEDIE_POWER,
        linkPower=0.0,
        regParam=0.01,
        maxIter=max_iter,
        featuresCol="inputs",
        labelCol="sales",
    )


def tree_stage(n_trees: int = N_TREES, depth: int = TREE_DEPTH) -> GBTRegressor:
    """Boosted trees with row and column sampling."""
    return GBTRegressor(
        maxIter=n_trees,
        maxDepth=depth,
        stepSize=LEARNING_RATE,
        subsamplingRate=SAMPLE_FRACTION,
        featureSubsetStrategy=str(SAMPLE_FRACTION),
        minInstancesPerNode=MIN_ROWS_PER_LEAF,
        seed=SEED,
        featuresCol="inputs",
        labelCol="sales",
    )


def train(df: DataFrame, stage, means_path: str) -> DemandModel:
    """Fit one model over all series.

    The encodings are written before they are used: the fit passes over the
    training rows many times, and a stored table is not recomputed each time.
    """
    numeric, categories = prepare_features(df)
    target_means(df, categories).write.mode("overwrite").parquet(means_path)
    means = df.sparkSession.read.parquet(means_path)
    encoded = encode(with_inputs(df, numeric), means, categories)
    cols = [f"{c}_in" for c in numeric] + [f"{c}_enc" for c in categories]
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="inputs"), stage])
    # Kept over the iterations of the fit; lost partitions are rebuilt from files.
    rows = encoded.select("sales", *cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = pipeline.fit(rows)
        spreads = rows.agg(*[F.coalesce(F.stddev_samp(f"`{c}`"), F.lit(0.0)) for c in cols]).first()
    finally:
        rows.unpersist()
    return DemandModel(fitted, means, numeric, categories, list(spreads))


def fingerprint(df: DataFrame, stage) -> str:
    """What a model depends on: the rows in any order, their columns, and the settings of the learner.

    Rows are hashed where they are; their number, sum and exclusive-or are
    added up, so neither the order nor the layout matters and equal rows count.
    """
    columns = sorted(df.columns)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns])
    sums = df.agg(F.count("*"), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row), F.bit_xor(F.xxhash64(row))).first()
    settings = sorted((p.name, str(v)) for p, v in stage.extractParamMap().items() if p.name not in ("predictionCol",))
    told = json.dumps([type(stage).__name__, settings, sorted(df.dtypes), [str(x) for x in sums]])
    return hashlib.sha256(told.encode()).hexdigest()


def train_or_reuse(train_df: DataFrame, val_df: DataFrame, stage, folder: str) -> tuple[DemandModel, DataFrame, bool]:
    """The stored model and predictions if they come from these rows and settings, else new ones.

    Returns model, predictions, and whether they were reused. The fingerprint
    of training and validation rows is written last, so a run that broke off
    leaves nothing that would be reused.
    """
    spark = train_df.sparkSession
    model_path, pred_path, mark = f"{folder}/model", f"{folder}/predictions", f"{folder}/fingerprint"
    wanted = f"{fingerprint(train_df, stage)}-{fingerprint(val_df, stage)}"
    if path_exists(spark, mark) and [r[0] for r in spark.read.parquet(mark).collect()] == [wanted]:
        return DemandModel.load(spark, model_path), spark.read.parquet(pred_path), True
    model = train(train_df, stage, f"{folder}/means")
    model.save(model_path)
    write_predictions(model.predict(val_df), pred_path)
    spark.createDataFrame([(wanted,)], "fingerprint string").coalesce(1).write.mode("overwrite").parquet(mark)
    return model, spark.read.parquet(pred_path), False


def top_features(importance: DataFrame, n: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def last_values(features: DataFrame, keys: Sequence[str] = SERIES_COLS, day_col: str = "day_num") -> DataFrame:
    """The last non-null value of every column per series."""
    others = [c for c in features.columns if c not in keys]
    last = [
        F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(day_col))).alias(c) for c in others
    ]
    return features.groupBy(*keys).agg(*last)


def horizon_template(last: DataFrame, horizon: int = HORIZON_DAYS, calendar: DataFrame | None = None) -> DataFrame:
    """One row per series and step ahead; only the day moves on.

    With ``calendar`` (columns ``day_num`` and calendar features) those
    features come from the future days instead of being frozen too.
    """
    steps = last.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    steps = steps.withColumn("day_num", F.col("day_num") + F.col("h"))
    if calendar is None:
        return steps
    known = [c for c in calendar.columns if c != "day_num"]
    return steps.drop(*known).join(broadcast_if_small(calendar), "day_num", "left")


def horizon_forecast(model: DemandModel, template: DataFrame) -> DataFrame:
    """Forecasts of all series, clipped at 0 and rounded to cents."""
    scored = model.predict(template)
    return scored.select(*SERIES_COLS, "h", "day_num", round_cents(F.col("pred")).alias("forecast"))


def forecast_of(forecasts: DataFrame, store_id: str, item_id: str) -> DataFrame:
    """The forecast list of one series; no row when the series is unknown."""
    one = forecasts.where((F.col("store_id") == store_id) & (F.col("item_id") == item_id))
    return one.groupBy(*SERIES_COLS).agg(
        F.count("*").alias("horizon_days"),
        F.transform(F.array_sort(F.collect_list(F.struct("h", "forecast"))), lambda s: s["forecast"]).alias("forecasts"),
    )
