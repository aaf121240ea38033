"""Counts, distributions, heatmaps, summaries and histograms over the feature table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.functions.scalar import label_name
from hourloom.operators.quantiles import exact_quantiles

LABEL = "mismatch_label"


def filter_entities(df: DataFrame, entities: Iterable[str] | None) -> DataFrame:
    """Rows of the listed series; no list, or an empty one, keeps everything."""
    entities = list(entities or ())
    return df.where(F.col("ba").isin(entities)) if entities else df


def filter_time(df: DataFrame, start: str, end: str, whole_last_day: bool = False) -> DataFrame:
    """Rows from ``start`` to ``end``, both included.

    A plain date means its first instant, so of the last day only midnight is kept unless
    ``whole_last_day`` is set.  Where the table has them, ``year`` prunes partitions and ``ts_unix``, whose
    statistics are stored, skips row groups.
    """
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    ts = F.col("ts")
    end_of = last + F.expr("INTERVAL 1 DAY") if whole_last_day else last
    if "year" in df.columns:
        df = df.where(F.col("year").between(F.year(first), F.year(end_of)))
    if "ts_unix" in df.columns:
        df = df.where(F.col("ts_unix").between(F.unix_timestamp(first), F.unix_timestamp(end_of)))
    if whole_last_day:
        return df.where((ts >= first) & (ts < last + F.expr("INTERVAL 1 DAY")))
    return df.where(ts.between(first, last))


def normal_hours(df: DataFrame) -> DataFrame:
    return df.where(F.col(LABEL) == 0)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def rows_per_year(df: DataFrame) -> DataFrame:
    return df.groupBy("year").agg(F.count("*").alias("rows"))


def entity_count(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("ba").alias("entities"))


def entity_list(df: DataFrame) -> DataFrame:
    return df.select("ba").dropna().distinct().orderBy("ba")


def class_distribution(df: DataFrame) -> DataFrame:
    """``(mismatch_label, rows, percent)``; rows without a label count in the total only."""
    counted = df.groupBy(LABEL).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("percent", F.col("rows") * 100.0 / total).where(F.col(LABEL).isNotNull())


def class_counts_named(df: DataFrame) -> DataFrame:
    """``(severity_class, rows)`` in order of the class name; rows without a label are left out."""
    named = df.where(F.col(LABEL).isNotNull()).groupBy(LABEL).agg(F.count("*").alias("rows"))
    return named.select(label_name(F.col(LABEL)).alias("severity_class"), "rows").orderBy("severity_class")


def _class_share(code: int) -> Column:
    return F.avg(F.when(F.col(LABEL) == code, 1.0).otherwise(0.0))


def mismatch_heatmap(df: DataFrame) -> DataFrame:
    """``(hour_of_day, month, rows, share_0 .. share_3)`` over the labelled rows, in one pass."""
    return (
        df.where(F.col(LABEL).isNotNull() & F.col("hour_of_day").isNotNull() & F.col("month").isNotNull())
        .groupBy("hour_of_day", "month")
        .agg(F.count("*").alias("rows"), *[_class_share(code).alias(f"share_{code}") for code in S.CLASS_NAMES])
    )


MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def heatmap_pivot(heatmap: DataFrame, code: int) -> DataFrame:
    """Share of one class, hours as rows and months as columns; absent cells are null."""
    wide = heatmap.groupBy("hour_of_day").pivot("month", list(range(1, 13))).agg(F.first(f"share_{code}"))
    return wide.select("hour_of_day", *[F.col(str(i + 1)).alias(name) for i, name in enumerate(MONTHS)])


def summary(df: DataFrame) -> DataFrame:
    """Rows, mean solar, wind and demand, and the percent of all rows in deficit."""
    return df.agg(
        F.count("*").alias("rows"),
        *[F.avg(f"{s}_mw").alias(f"avg_{s}_mw") for s in S.HISTORY_SIGNALS],
        (_class_share(3) * 100).alias("deficit_pct"),
    )


def deficit_share(df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Percent of rows in deficit; rows without a label count as not in deficit."""
    return df.groupBy(*by).agg((_class_share(3) * 100).alias("deficit_pct"))


def score_range(scores: DataFrame, score: str = "anomaly_score", share: float = 0.99) -> DataFrame:
    """``(low, high, threshold)``; the threshold is the exact quantile ``share``.  NaN counts as no score."""
    threshold = exact_quantiles(scores, score, [share]).select(score).scalar()
    return scores.where(~F.isnan(F.col(score).cast("double"))).agg(F.min(score).alias("low"), F.max(score).alias("high")).withColumn("threshold", threshold)


def score_thresholds(scores: DataFrame, score: str = "anomaly_score", share: float = 0.99) -> DataFrame:
    """``(ba, threshold)``: each series' own quantile, for use where no overall one is stored."""
    return exact_quantiles(scores, score, [share], ["ba"]).select("ba", F.col(score).alias("threshold"))


def histogram(scores: DataFrame, score: str = "anomaly_score", bins: int = 100) -> DataFrame:
    """``(bin, low, high, rows)`` for ``bins`` equal steps from the least to the greatest score.

    The last bin includes the greatest score; empty bins are listed with 0 rows.
    """
    values = scores.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    edges = values.agg(F.struct(F.min(score).alias("low"), F.max(score).alias("high")).alias("edges"))
    low, high = edges.scalar()["low"], edges.scalar()["high"]
    width = (high - low) / bins
    position = F.when(width > 0, F.least(F.floor((F.col(score) - low) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = values.select(position.cast("int").alias("bin")).groupBy("bin").agg(F.count("*").alias("rows"))
    empty = edges.where("edges.low IS NOT NULL").select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "edges"
    )
    step = (F.col("edges.high") - F.col("edges.low")) / bins
    return empty.join(counts, "bin", "left").select(
        "bin",
        (F.col("edges.low") + F.col("bin") * step).alias("low"),
        (F.col("edges.low") + (F.col("bin") + 1) * step).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def describe(df: DataFrame, value: str) -> DataFrame:
    """``(count, mean, std, min, q25, q50, q75, max)`` of one column; std divides by n - 1."""
    quartiles = exact_quantiles(df, value, [0.25, 0.5, 0.75])
    quarter = {f"q{int(p * 100)}": F.max(F.when(F.col("probability") == p, F.col(value))) for p in (0.25, 0.5, 0.75)}
    picked = quartiles.agg(F.struct(*[q.alias(name) for name, q in quarter.items()]).alias("quarters")).scalar()
    basic = df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return basic.select("count", "mean", "std", "min", *[picked[name].alias(name) for name in quarter], "max")


def anomaly_flags(scores: DataFrame, threshold: Column, score: str = "anomaly_score") -> DataFrame:
    """``(ba, rows, flagged, share)`` of scores above ``threshold`` (a literal or scalar subquery)."""
    above = F.count_if(F.col(score) > threshold)
    return (
        scores.where(F.col(score).isNotNull())
        .groupBy("ba")
        .agg(F.count("*").alias("rows"), above.alias("flagged"), (above / F.count("*")).alias("share"))
    )


def timeline(df: DataFrame, entity: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of one series in time order, within a time range if given."""
    chosen = df.where(F.col("ba") == entity)
    if start is not None and end is not None:
        chosen = filter_time(chosen, start, end)
    return chosen.orderBy("ts_unix")


def in_series_order(df: DataFrame) -> DataFrame:
    return df.orderBy("ba", "ts_unix")


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    return df.limit(n)
