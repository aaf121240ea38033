"""Regression and classification metrics; each is one pass with sums only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions import schema as S


def _pair(actual: Column, predicted: Column) -> list[Column]:
    """n, mean absolute error, root mean squared error and R2 over rows that have both values.

    R2 compares with the mean of the actual values; for constant actual values it is 1 if
    every prediction is right and else 0.
    """
    both = actual.isNotNull() & predicted.isNotNull()
    a, error = F.when(both, actual), actual - predicted
    n, residual = F.count_if(both), F.sum(error * error)
    total = F.var_pop(a) * n
    return [
        n.alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(residual / F.when(n > 0, n)).alias("rmse"),
        F.when(total > 0, 1 - residual / total).when(residual == 0, 1.0).when(n > 0, 0.0).alias("r2"),
    ]


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Iterable[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*_pair(F.col(actual), F.col(predicted)))


def persistence_metrics(features: DataFrame) -> DataFrame:
    """``(source, horizon, n, mae, rmse, r2)`` of "the value stays as it is" for every target."""
    results = []
    for source in S.LEAD_SIGNALS:
        for h in S.LEAD_HOURS:
            measured = _pair(F.col(S.lead_name(source, h)), F.col(f"{source}_mw"))
            results.append(F.struct(F.lit(source).alias("source"), F.lit(f"{h}h").alias("horizon"), *measured))
    return features.agg(F.array(*results).alias("results")).select(F.inline("results"))


def metrics_pivot(metrics: DataFrame, metric: str = "mae", sources: Iterable[str] = S.LEAD_SIGNALS) -> DataFrame:
    """One row per horizon, one column per source."""
    return metrics.groupBy("horizon").pivot("source", list(sources)).agg(F.first(metric))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _class_counts(df: DataFrame, actual: str, predicted: str, names: dict[int, str]) -> DataFrame:
    """One row per class of the fixed list, present or not: true positives, predicted, actual."""
    y, p = F.col(actual), F.col(predicted)
    counted = [
        F.struct(
            F.lit(name).alias("class"),
            F.count_if((y == code) & (p == code)).alias("hits"),
            F.count_if(y.isNotNull() & (p == code)).alias("predicted"),
            F.count_if((y == code) & p.isNotNull()).alias("support"),
        )
        for code, name in names.items()
    ]
    return df.agg(F.array(*counted).alias("classes")).select(F.inline("classes"))


def classification_report(
    df: DataFrame, actual: str, predicted: str, names: dict[int, str] = S.REPORT_CLASS_NAMES
) -> DataFrame:
    """``(class, precision, recall, f1, support)``: the classes, accuracy, macro and weighted means."""
    precision, recall = _ratio(F.col("hits"), F.col("predicted")), _ratio(F.col("hits"), F.col("support"))
    scored = _class_counts(df, actual, predicted, names).select(
        "class",
        "hits",
        "support",
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * precision * recall, precision + recall).alias("f1"),
    )
    measures = ("precision", "recall", "f1")
    rows = F.sum("support")
    accuracy = _ratio(F.sum("hits"), rows)
    summary = scored.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), *[accuracy.alias(m) for m in measures], rows.alias("support")),
            F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], rows.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("class"),
                *[_ratio(F.sum(F.col(m) * F.col("support")), rows).alias(m) for m in measures],
                rows.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return scored.select("class", *measures, "support").unionByName(summary)


def confusion_matrix(df: DataFrame, actual: str, predicted: str, classes: Iterable[int] = tuple(S.CLASS_NAMES)) -> DataFrame:
    """``(actual, predicted, rows, share)`` for every pair of classes; shares of one actual class
    sum to 1, or are 0 where the class does not occur."""
    classes = list(classes)
    y, p = F.col(actual), F.col(predicted)
    cells = [
        F.struct(
            F.lit(a).alias("actual"),
            F.lit(b).alias("predicted"),
            F.count_if((y == a) & (p == b)).alias("rows"),
            _ratio(F.count_if((y == a) & (p == b)), F.count_if((y == a) & p.isin(classes))).alias("share"),
        )
        for a in classes
        for b in classes
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
