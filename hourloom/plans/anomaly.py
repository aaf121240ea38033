"""Anomaly scores: how badly a model of normal hours rebuilds a week-long sequence.

Standardise the signals on normal hours, learn the principal components of sequences of normal
hours, and score every sequence by the mean squared error left after projecting on them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators.cleaning import complete_cases
from hourloom.operators.reports import normal_hours, score_range
from hourloom.operators.sampling import SEED, held_out_column
from hourloom.operators.sketches import score_sketches, sketched_range
from hourloom.operators.sliding import projection_errors, window_moments
from hourloom.operators.windows import sequences
from hourloom.sources.tables import write_scores

SCORES_SCHEMA = "ba string, ts_unix bigint, anomaly_score double"


@dataclass(frozen=True)
class AnomalySettings:
    length: int = S.SEQUENCE_HOURS
    components: int = 64
    contiguous: bool = False
    holdout: float = 0.1
    seed: int = SEED
    #: SQL text of a number from 0 to 1 that decides the split in place of the key hash.
    score: str | None = None


def signal_scales(normal: DataFrame, signals: Iterable[str] = S.SEQUENCE_SIGNALS) -> DataFrame:
    """One row ``(<signal>_mean, <signal>_std, ..)``; population deviation, 1 where it is zero."""
    statistics = []
    for s in signals:
        deviation = F.stddev_pop(s)
        statistics.append(F.avg(s).alias(f"{s}_mean"))
        statistics.append(F.when(deviation > 0, deviation).otherwise(1.0).alias(f"{s}_std"))
    return normal.agg(*statistics)


def standardise(df: DataFrame, scales: DataFrame, signals: Iterable[str] = S.SEQUENCE_SIGNALS) -> DataFrame:
    """``df`` with each signal as deviations from its mean; the scales are a one-row subquery."""
    signals = list(signals)
    row = scales.select(F.struct("*").alias("scales")).scalar()
    scaled: dict[str, Column] = {s: ((F.col(s) - row[f"{s}_mean"]) / row[f"{s}_std"]).alias(s) for s in signals}
    return df.select(*[scaled.get(c, F.col(c)) for c in df.columns])


def _vectors(rows: DataFrame, settings: AnomalySettings) -> DataFrame:
    built = sequences(rows, length=settings.length, contiguous=settings.contiguous)
    return built.select("ba", "ts_unix", array_to_vector("sequence").alias("sequence"))


def _stages(settings: AnomalySettings) -> tuple[StandardScaler, PCA]:
    """Centre, then project; the projection itself does not centre."""
    width = settings.length * len(S.SEQUENCE_SIGNALS)
    return (
        StandardScaler(inputCol="sequence", outputCol="centred", withMean=True, withStd=False),
        PCA(k=min(settings.components, width), inputCol="centred", outputCol="projected"),
    )


def fit_reconstruction(train: DataFrame, settings: AnomalySettings) -> PipelineModel:
    """The model of sequences that are written out as vectors."""
    return Pipeline(stages=list(_stages(settings))).fit(train)


def reconstruction_of(spark: SparkSession, mean: np.ndarray, covariance: np.ndarray, settings: AnomalySettings) -> PipelineModel:
    """The same model from the sequences' mean and covariance."""
    centre, project = _stages(settings)
    values, vectors = np.linalg.eigh(covariance)
    k, total = project.getK(), max(float(values.clip(0).sum()), 1e-300)
    components = DenseMatrix(len(mean), k, vectors[:, ::-1][:, :k].ravel(order="F").tolist())
    feature, empty = spark._jvm.org.apache.spark.ml.feature, spark._jvm.org.apache.spark.ml.param.ParamMap.empty()
    java = [
        _py2java(spark.sparkContext, value)
        for value in (Vectors.dense(np.ones(len(mean))), Vectors.dense(mean), components, Vectors.dense(values[::-1][:k].clip(0) / total))
    ]
    for stage in (centre, project):
        stage._transfer_params_to_java()
    scaler = centre._java_obj.copyValues(feature.StandardScalerModel(centre.uid, java[0], java[1]), empty)
    pca = project._java_obj.copyValues(feature.PCAModel(project.uid, java[2], java[3]), empty)
    return PipelineModel([StandardScalerModel(scaler), PCAModel(pca)])


def sequence_scores(model: PipelineModel, rows: DataFrame, settings: AnomalySettings) -> DataFrame:
    """``(ba, ts_unix, anomaly_score)`` of every sequence of ``rows`` (standardised signals), without writing the sequences out."""
    mean, components = model.stages[0].mean.toArray(), model.stages[1].pc.toArray()
    errors = projection_errors(rows, S.SEQUENCE_SIGNALS, settings.length, mean, components, settings.contiguous)
    return errors.select("ba", "ts_unix", F.col("error").alias("anomaly_score"))


def _energy(vector: str) -> Column:
    return F.aggregate(vector_to_array(F.col(vector)), F.lit(0.0), lambda total, x: total + x * x)


def reconstruction_error(model: PipelineModel, vectors: DataFrame, settings: AnomalySettings) -> DataFrame:
    """The components are orthonormal, so the squared error is what the projection leaves out."""
    width = settings.length * len(S.SEQUENCE_SIGNALS)
    error = F.greatest((_energy("centred") - _energy("projected")) / width, F.lit(0.0))
    return model.transform(vectors).select("ba", "ts_unix", error.alias("anomaly_score"))


def train_anomaly(
    features: DataFrame, settings: AnomalySettings = AnomalySettings()
) -> tuple[PipelineModel | None, DataFrame, DataFrame, DataFrame]:
    """The model, the scales, scores of all sequences and the mean error on held-out normal ones.

    ``features`` should be a stored table, of which eight columns are read, several times.

    A score belongs to the last hour of its sequence.  Training sequences are built from normal
    hours only and so may step over the hours between; sequences never mix two series.
    """
    panel = complete_cases(features.select("ba", "ts_unix", "mismatch_label", *S.SEQUENCE_SIGNALS), S.SEQUENCE_SIGNALS)
    scales = signal_scales(normal_hours(panel))
    scaled = standardise(panel, scales)
    held_out = held_out_column(settings.holdout, seed=settings.seed, score=F.expr(settings.score) if settings.score else None)
    normal, spark = normal_hours(scaled), features.sparkSession
    n, mean, covariance = window_moments(normal, S.SEQUENCE_SIGNALS, settings.length, ~held_out, settings.contiguous)
    if n < 2:
        return None, scales, spark.createDataFrame([], SCORES_SCHEMA), spark.createDataFrame([], "loss double")
    model = reconstruction_of(spark, mean, covariance, settings)
    scores = sequence_scores(model, scaled, settings)
    loss = sequence_scores(model, normal, settings).where(held_out).agg(F.avg("anomaly_score").alias("loss"))
    return model, scales, scores, loss


def save_anomaly(
    model: PipelineModel, scales: DataFrame, scores: DataFrame, directory: str, loss: DataFrame | None = None
) -> None:
    """Scores, and the hold-out ``loss`` if given, are stored before the threshold is found from them, so they are computed once."""
    spark = scores.sparkSession
    model.write().overwrite().save(f"{directory}/anomaly_model")
    scales.coalesce(1).write.mode("overwrite").parquet(f"{directory}/anomaly_scales")
    write_scores(scores, f"{directory}/anomaly_scores")
    if loss is not None:
        loss.coalesce(1).write.mode("overwrite").parquet(f"{directory}/anomaly_loss")
    stored = spark.read.parquet(f"{directory}/anomaly_scores")
    score_range(stored).write.mode("overwrite").parquet(f"{directory}/anomaly_threshold")
    score_sketches(stored).write.mode("overwrite").parquet(f"{directory}/anomaly_sketches")


def sketched_threshold(
    spark: SparkSession, directory: str, entities: Iterable[str] = (), first_year: int | None = None, last_year: int | None = None, share: float = 0.99
) -> DataFrame:
    """``(n, low, high, threshold)`` of some series and years, from the stored sketches alone; all of them by default."""
    sketches, entities = spark.read.parquet(f"{directory}/anomaly_sketches"), list(entities)
    if entities:
        sketches = sketches.where(F.col("ba").isin(entities))
    if first_year is not None:
        sketches = sketches.where(F.col("year") >= first_year)
    if last_year is not None:
        sketches = sketches.where(F.col("year") <= last_year)
    return sketched_range(sketches, share)


def load_anomaly(spark: SparkSession, directory: str) -> tuple[PipelineModel, DataFrame, DataFrame, DataFrame]:
    """Model, scales, scores and the one-row threshold table."""
    tables = [spark.read.parquet(f"{directory}/anomaly_{name}") for name in ("scales", "scores", "threshold")]
    return PipelineModel.load(f"{directory}/anomaly_model"), *tables
