"""Generation forecasters: one boosted-tree regressor per source and horizon."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators.metrics import regression_metrics
from hourloom.operators.sampling import SEED, sample_exact, split_by_key, split_by_time
from hourloom.plans.boosting import HELD_OUT, AbsoluteLoss, Boosted, BoostSettings, best_rounds, boost, loss_table, restart  # noqa: F401
from hourloom.plans.training import KEYS, feature_matrix
from hourloom.session import stored_meanwhile
from hourloom.sources.tables import load

TARGETS = [(source, hours) for source in S.LEAD_SIGNALS for hours in S.LEAD_HOURS]


@dataclass(frozen=True)
class ForecastSettings:
    rounds: int = 500
    patience: int = 50
    depth: int = 8
    step: float = 0.05
    share_of_rows: float = 0.8
    share_of_columns: float = 0.8
    holdout: float = 0.15
    split: str = "random"
    stop_early: bool = False
    seed: int = SEED
    #: SQL text of a number from 0 to 1 that decides the random split in place of the key hash.
    score: str | None = None


def _regressor(target: str, settings: ForecastSettings, validation: str | None = None) -> GBTRegressor:
    regressor = GBTRegressor(
        featuresCol="features",
        labelCol=target,
        predictionCol="prediction",
        lossType="absolute",
        maxIter=settings.rounds,
        maxDepth=settings.depth,
        stepSize=settings.step,
        subsamplingRate=settings.share_of_rows,
        featureSubsetStrategy=str(settings.share_of_columns),
        seed=settings.seed,
        validationTol=0.0,
    )
    return regressor if validation is None else regressor.setValidationIndicatorCol(validation)


def first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model after its first ``rounds`` rounds."""
    whole = model._java_obj
    trees, weights = whole.trees()[:rounds], whole.treeWeights()[:rounds]
    jvm = SparkSession.active()._jvm
    cut = jvm.org.apache.spark.ml.regression.GBTRegressionModel(whole.uid(), trees, weights, whole.numFeatures())
    return GBTRegressionModel(whole.copyValues(cut, jvm.org.apache.spark.ml.param.ParamMap.empty()))


def boost_settings(settings: ForecastSettings) -> BoostSettings:
    return BoostSettings(
        settings.rounds, settings.patience, settings.depth, settings.step, settings.share_of_rows, settings.share_of_columns, settings.seed
    )


def _both(train: DataFrame, held_out: DataFrame) -> DataFrame:
    return train.withColumn(HELD_OUT, F.lit(False)).unionByName(held_out.withColumn(HELD_OUT, F.lit(True)))


def fit_forecaster(
    train: DataFrame, held_out: DataFrame, target: str, settings: ForecastSettings, start: Boosted | None = None
) -> tuple[GBTRegressionModel, list[float]]:
    """The model up to the least hold-out error, and that error after every round fitted.

    Boosting starts from the mean and steps in units of the target's mean deviation. It ends when ``patience`` rounds did not lower the error; ``start`` goes on from earlier rounds. With ``stop_early``
    MLlib's own boosting ends at the first round without gain, and tells no errors.
    """
    if settings.stop_early and not held_out.isEmpty():
        return _regressor(target, settings, HELD_OUT).fit(_both(train, held_out)), []
    mean = train.agg(F.avg(target)).first()[0]
    spread = train.agg(F.avg(F.abs(F.col(target) - mean))).first()[0]
    boosted = boost(_both(train, held_out), target, AbsoluteLoss(spread or 1.0, 0), boost_settings(settings), start)
    return boosted.models()[0], boosted.losses


def _split(matrix: DataFrame, target: str, settings: ForecastSettings) -> tuple[DataFrame, DataFrame]:
    rows = matrix.select(*KEYS, "features", target).where(F.col(target).isNotNull())
    if settings.split == "time":
        return split_by_time(rows, settings.holdout)
    return split_by_key(rows, settings.holdout, score=F.expr(settings.score) if settings.score else None)


def train_with_losses(
    features: DataFrame,
    targets: Iterable[tuple[str, int]] = tuple(TARGETS),
    settings: ForecastSettings = ForecastSettings(),
    inputs: Iterable[str] | None = None,
    start: dict[tuple[str, int], Boosted] | None = None,
) -> tuple[dict[tuple[str, int], GBTRegressionModel], DataFrame, DataFrame]:
    """Models by (source, horizon), ``(source, horizon, n, mae, rmse, r2)`` on the hold-out rows, and
    ``(source, horizon, round, loss)`` of all rounds.

    ``features`` should be a stored table. Its inputs are read and checked once: the matrix of all targets is stored for the time
    of the training, and each model takes from it the rows that have its target. The models are fitted side by side, since each
    waits for many small jobs. ``start`` holds states to go on from.
    """
    spark = features.sparkSession
    targets = [(s, h) for s, h in dict.fromkeys(targets) if S.lead_name(s, h) in features.columns]

    def fit(matrix: DataFrame, key: tuple[str, int]):
        target = S.lead_name(*key)
        train, held_out = _split(matrix, target, settings)
        if train.isEmpty():
            return None
        model, losses = fit_forecaster(train, held_out, target, settings, (start or {}).get(key))
        scored = regression_metrics(model.transform(held_out), target, "prediction").collect()
        return model, [(key[0], f"{key[1]}h", *row) for row in scored], [(key[0], f"{key[1]}h", i + 1, float(x)) for i, x in enumerate(losses)]

    fitted = {}
    if targets:
        matrix = feature_matrix(features, list(inputs or S.forecast_features()), [S.lead_name(*key) for key in targets])
        with stored_meanwhile(matrix, "forecast-matrix") as kept, ThreadPoolExecutor(len(targets)) as pool:
            found = pool.map(lambda key: fit(kept, key), targets)
            fitted = {key: one for key, one in zip(targets, found) if one is not None}
    scored, told = ([row for one in fitted.values() for row in one[i]] for i in (1, 2))
    metrics = spark.createDataFrame(scored, "source string, horizon string, n bigint, mae double, rmse double, r2 double")
    losses = spark.createDataFrame(told, "source string, horizon string, round int, loss double")
    return {key: one[0] for key, one in fitted.items()}, metrics, losses


def train_forecasters(
    features: DataFrame,
    targets: Iterable[tuple[str, int]] = tuple(TARGETS),
    settings: ForecastSettings = ForecastSettings(),
    inputs: Iterable[str] | None = None,
) -> tuple[dict[tuple[str, int], GBTRegressionModel], DataFrame]:
    """Models and metrics of :func:`train_with_losses`."""
    return train_with_losses(features, targets, settings, inputs)[:2]


def predict(model: GBTRegressionModel, features: DataFrame, target: str, inputs: Iterable[str] | None = None) -> DataFrame:
    """``(ba, ts_unix, actual, prediction)`` for rows with all inputs."""
    matrix = feature_matrix(features, inputs or S.forecast_features(), [target])
    return model.transform(matrix).select("ba", "ts_unix", F.col(target).alias("actual"), "prediction")


def compare_on_sample(
    model: GBTRegressionModel,
    features: DataFrame,
    target: str,
    n: int = 10_000,
    inputs: Iterable[str] | None = None,
    score: Column | None = None,
) -> DataFrame:
    """Actual and predicted values of ``n`` rows that have both."""
    rows = feature_matrix(features, inputs or S.forecast_features(), [target]).where(F.col(target).isNotNull())
    picked = model.transform(sample_exact(rows, n, score=score))
    return picked.select("ba", "ts_unix", F.col(target).alias("actual"), "prediction")


def save_forecasters(
    models: dict[tuple[str, int], GBTRegressionModel], metrics: DataFrame, directory: str, losses: DataFrame | None = None
) -> None:
    """Models, their metrics, and the losses of their rounds if given."""
    for (source, hours), model in models.items():
        model.write().overwrite().save(f"{directory}/forecast_{source}_{hours}h")
    metrics.coalesce(1).write.mode("overwrite").parquet(f"{directory}/forecast_metrics")
    if losses is not None:
        losses.coalesce(1).write.mode("overwrite").parquet(f"{directory}/forecast_losses")


def load_forecaster(directory: str, source: str, hours: int) -> GBTRegressionModel:
    return GBTRegressionModel.load(f"{directory}/forecast_{source}_{hours}h")


def load_metrics(spark: SparkSession, directory: str) -> DataFrame:
    return load(spark, f"{directory}/forecast_metrics")


def load_losses(spark: SparkSession, directory: str) -> DataFrame:
    return load(spark, f"{directory}/forecast_losses")


def restart_forecaster(spark: SparkSession, directory: str, source: str, hours: int, patience: int) -> Boosted:
    """The state of a stored forecaster with its losses, as a ``start`` for more rounds."""
    told = load_losses(spark, directory).where((F.col("source") == source) & (F.col("horizon") == f"{hours}h")).orderBy("round")
    return restart([load_forecaster(directory, source, hours)], patience, [r["loss"] for r in told.toLocalIterator()])
