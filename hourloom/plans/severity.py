"""Classifier of the four mismatch classes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators.metrics import classification_report
from hourloom.operators.sampling import SEED, holdout_cuts, mark_holdout
from hourloom.plans.boosting import HELD_OUT, Boosted, BoostSettings, SoftmaxLoss, SoftmaxModel, boost, loss_table
from hourloom.plans.training import KEYS, feature_matrix
from hourloom.session import stored_meanwhile

LABEL = "mismatch_label"


@dataclass(frozen=True)
class SeveritySettings:
    """``softmax`` boosts all classes at once, ``boosted`` one against the rest, ``forest`` is a random forest.

    ``trees`` are rounds for the boosted kinds; ``softmax`` ends after ``patience`` rounds without a lower hold-out loss.
    """

    trees: int = 400
    patience: int = 40
    depth: int = 8
    step: float = 0.05
    share_of_rows: float = 0.8
    share_of_columns: float = 0.8
    holdout: float = 0.15
    kind: str = "softmax"
    exclude_label_source: bool = False
    seed: int = SEED
    #: SQL text of a number that decides the split in place of the key hash.
    score: str | None = None


def _classifier(settings: SeveritySettings):
    if settings.kind == "forest":
        return RandomForestClassifier(
            labelCol=LABEL,
            numTrees=settings.trees,
            maxDepth=settings.depth,
            subsamplingRate=settings.share_of_rows,
            featureSubsetStrategy=str(settings.share_of_columns),
            seed=settings.seed,
        )
    if settings.kind == "boosted":
        # MLlib boosts two classes only, so each class is told from the rest.
        boosted = GBTClassifier(
            maxIter=settings.trees,
            maxDepth=settings.depth,
            stepSize=settings.step,
            subsamplingRate=settings.share_of_rows,
            featureSubsetStrategy=str(settings.share_of_columns),
            seed=settings.seed,
        )
        return OneVsRest(classifier=boosted, labelCol=LABEL)
    raise ValueError(f"kind must be 'softmax', 'forest' or 'boosted', got {settings.kind!r}")


def severity_matrix(features: DataFrame, settings: SeveritySettings, inputs: Iterable[str] | None = None) -> tuple[DataFrame, list[str]]:
    used = S.available(inputs or S.severity_features(settings.exclude_label_source), features.columns)
    matrix = feature_matrix(features, used, [LABEL]).where(F.col(LABEL).isNotNull())
    return matrix.withColumn(LABEL, F.col(LABEL).cast("double")), used


def fit_softmax(rows: DataFrame, settings: SeveritySettings, start: Boosted | None = None) -> Boosted:
    """Boosting on a severity matrix with ``__held_out``; ``start`` goes on from earlier rounds."""
    boosting = BoostSettings(
        settings.trees, settings.patience, settings.depth, settings.step, settings.share_of_rows, settings.share_of_columns, settings.seed
    )
    return boost(rows, LABEL, SoftmaxLoss(len(S.CLASS_NAMES)), boosting, start)


def train_severity(
    features: DataFrame, settings: SeveritySettings = SeveritySettings(), inputs: Iterable[str] | None = None
) -> tuple[Model | SoftmaxModel | None, list[str], DataFrame]:
    """The model (none without rows), its inputs in order, and ``(ba, ts_unix, actual, predicted)``
    of the hold-out rows."""
    matrix, used = severity_matrix(features, settings, inputs)
    score = F.expr(settings.score) if settings.score else None
    with stored_meanwhile(matrix.select(*KEYS, LABEL), "severity-keys") as rows:
        cuts = holdout_cuts(rows, LABEL, settings.holdout, seed=settings.seed, score=score)
    marked = mark_holdout(matrix, LABEL, settings.holdout, seed=settings.seed, score=score, cuts=cuts)
    train, held_out = marked.where(~F.col("held_out")).drop("held_out"), marked.where("held_out").drop("held_out")
    if train.isEmpty():
        empty = "ba string, ts_unix bigint, actual int, predicted int"
        return None, used, features.sparkSession.createDataFrame([], empty)
    if settings.kind == "softmax":
        boosted = fit_softmax(marked.withColumnRenamed("held_out", HELD_OUT), settings)
        model = SoftmaxModel(boosted.models(), boosted.losses)
    else:
        model = _classifier(settings).fit(train)
    return model, used, classify(model, held_out)


def classify(model: Model | SoftmaxModel, matrix: DataFrame) -> DataFrame:
    return model.transform(matrix).select(
        "ba", "ts_unix", F.col(LABEL).cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted")
    )


def importances(spark: SparkSession, model: Model | SoftmaxModel, inputs: list[str]) -> DataFrame:
    """``(name, importance)``, summing to 1; one row per input.  Of boosted classes the mean counts, without those that no
    input tells apart; if none is, all are 0."""
    parts = model.models if isinstance(model, (OneVsRestModel, SoftmaxModel)) else [model]
    mean = np.mean([p.featureImportances.toArray() for p in parts], axis=0)
    pairs = zip(inputs, (mean / (mean.sum() or 1.0)).tolist())
    return spark.createDataFrame([(n, float(v)) for n, v in pairs], "name string, importance double")


def top_importances(spark: SparkSession, model: Model | SoftmaxModel, inputs: list[str], n: int = 20) -> DataFrame:
    return importances(spark, model, inputs).orderBy(F.desc("importance"), "name").limit(n)


def save_severity(model: Model | SoftmaxModel, inputs: list[str], predictions: DataFrame, directory: str) -> None:
    """Model, its kind, input names, the report on the hold-out rows and, for softmax, the loss of every round."""
    spark = predictions.sparkSession
    if isinstance(model, SoftmaxModel):
        kind = "softmax"
        model.save(f"{directory}/severity_model")
        loss_table(spark, model.losses).coalesce(1).write.mode("overwrite").parquet(f"{directory}/severity_losses")
    else:
        kind = "boosted" if isinstance(model, OneVsRestModel) else "forest"
        model.write().overwrite().save(f"{directory}/severity_model")
    spark.createDataFrame([(kind,)], "kind string").coalesce(1).write.mode("overwrite").parquet(f"{directory}/severity_kind")
    names = spark.createDataFrame(list(enumerate(inputs)), "pos int, name string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{directory}/severity_inputs")
    report = classification_report(predictions, "actual", "predicted")
    report.coalesce(1).write.mode("overwrite").parquet(f"{directory}/severity_report")


def load_severity(spark: SparkSession, directory: str, kind: str | None = None) -> tuple[Model | SoftmaxModel, list[str]]:
    """Model and input names; the kind is read from what is stored unless given."""
    kind = kind or spark.read.parquet(f"{directory}/severity_kind").first()["kind"]
    names = [row["name"] for row in spark.read.parquet(f"{directory}/severity_inputs").orderBy("pos").toLocalIterator()]
    if kind == "softmax":
        model = SoftmaxModel.load(f"{directory}/severity_model", len(S.CLASS_NAMES))
        model.losses = [r["loss"] for r in spark.read.parquet(f"{directory}/severity_losses").orderBy("round").toLocalIterator()]
        return model, names
    reader = OneVsRestModel if kind == "boosted" else RandomForestClassificationModel
    return reader.load(f"{directory}/severity_model"), names
