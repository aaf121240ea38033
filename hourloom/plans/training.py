"""Preparing rows for MLlib: clean, complete, assembled, stored once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions.schema import available
from hourloom.operators.cleaning import finite_or_null

KEYS = ["ba", "ts_unix"]


def feature_matrix(features: DataFrame, inputs: Iterable[str], targets: Iterable[str]) -> DataFrame:
    """``(ba, ts_unix, features, *targets)`` of the rows in which every input is a finite number.

    Targets may still be null: each model drops its own.  ``features`` should be a stored table:
    the optimizer takes minutes over a filter on 170 window expressions.
    """
    inputs, targets = available(inputs, features.columns), list(targets)
    values = F.array(*[F.col(c).cast("double") for c in inputs])
    # Null and NaN fail the comparison as infinities do.  One expression, so that the optimizer does
    # not derive conditions from each of 170.
    complete = features.where(F.forall(values, lambda v: F.abs(v) < float("inf")))
    finite = finite_or_null(complete.select(*dict.fromkeys([*KEYS, *inputs, *targets])), targets)
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")
    return assembler.transform(finite).select(*KEYS, "features", *targets)
