"""Quantile sketches kept beside scores: merged for any series and years, without reading scores again.

A sketch of :data:`SIZE` holds some thousand values whatever the number of scores. Sketches are built where the scores lie, combined before the
shuffle, and merge without loss of their bound; they also know the exact number, least and greatest score.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The k of a KLL sketch.
SIZE = 2048


def rank_error(size: int = SIZE) -> float:
    """Twice the published error of ranks, as a share of n, that a sketch keeps in 99 of 100 cases; merging does not add to it."""
    return 2 * 2.296 / size**0.9021


def score_sketches(scores: DataFrame, score: str = "anomaly_score", size: int = SIZE) -> DataFrame:
    """``(ba, year, sketch)`` of the scores by series and year; null and NaN count as no score."""
    value = F.col(score).cast("double")
    kept = scores.where(value.isNotNull() & ~F.isnan(value))
    year = F.year(F.timestamp_seconds("ts_unix"))
    return kept.groupBy("ba", year.alias("year")).agg(F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch"))


def merged(sketches: DataFrame, by: Iterable[str] = (), size: int = SIZE) -> DataFrame:
    """``(*by, sketch)``: one sketch of each group; filter the rows first for a range of series or years."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")).where("sketch IS NOT NULL")


def quantile(sketch: Column | str, share: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(share)))


def sketched_range(sketches: DataFrame, share: float = 0.99, by: Iterable[str] = ()) -> DataFrame:
    """``(*by, n, low, high, threshold)``: number, least and greatest score are exact, the threshold's rank is off by at most
    ``rank_error()`` of n. No row without scores."""
    by = list(by)
    told = merged(sketches, by).select(*by, F.kll_sketch_get_n_double("sketch").alias("n"), "sketch").where("n > 0")
    return told.select(*by, "n", quantile("sketch", 0.0).alias("low"), quantile("sketch", 1.0).alias("high"), quantile("sketch", share).alias("threshold"))


def sketched_histogram(sketches: DataFrame, bins: int = 100) -> DataFrame:
    """``(bin, low, high, rows)`` as :func:`hourloom.operators.reports.histogram`; the rows below every edge are off by at most
    ``rank_error()`` of n, and all rows together are exact."""
    found = sketched_range(sketches).select("n", "low", "high").first()  # edges must be literals
    spark = sketches.sparkSession
    if found is None:
        return spark.createDataFrame([], "bin int, low double, high double, rows long")
    n, low, step = found["n"], found["low"], (found["high"] - found["low"]) / bins
    edges = [low + i * step for i in range(bins)] + [found["high"]]
    inner = [F.round(F.kll_sketch_get_rank_double("sketch", F.lit(edge)) * n).cast("long") for edge in edges[1:-1]]
    upto = [F.lit(0).cast("long"), *(inner if step > 0 else [F.lit(n).cast("long")] * (bins - 1)), F.lit(n).cast("long")]
    listed = [
        F.struct(F.lit(i).alias("bin"), F.lit(edges[i]).alias("low"), F.lit(edges[i] + step).alias("high"), (upto[i + 1] - upto[i]).alias("rows"))
        for i in range(bins)
    ]
    return merged(sketches).select(F.inline(F.array(*listed)))
