"""Samples and splits that depend on row keys only, so every run picks the same rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions.scalar import key_fraction, key_hash
from hourloom.operators.quantiles import order_statistics
from hourloom.session import durable, is_small, stored

SEED = 42


def _below(share: float, seed: int, keys: Iterable[str], score: Column | None) -> Column:
    """Whether a row's key hash, or a ``score`` from 0 to 1 in its place, is below ``share``; never null."""
    return F.coalesce((key_fraction(seed, *keys) if score is None else score) < share, F.lit(False))


def sample_rows(
    df: DataFrame, fraction: float, keys: Iterable[str] = ("ba", "ts_utc"), seed: int = SEED, score: Column | None = None
) -> DataFrame:
    """Rows picked one by one.  Lags computed on such a sample no longer step hour by hour."""
    return df.where(_below(fraction, seed, keys, score))


def sample_entities(
    df: DataFrame, fraction: float, column: str = "ba", seed: int = SEED, score: Column | None = None
) -> DataFrame:
    """Whole series, so windows on the sample are those of the full table."""
    return df.where(_below(fraction, seed, [column], score))


def sample_exact(
    df: DataFrame, n: int, keys: Iterable[str] = ("ba", "ts_unix"), seed: int = SEED, score: Column | None = None
) -> DataFrame:
    """The ``n`` rows with the smallest key hash (or ``score``, where it is not null); all of them if there are fewer.

    The hash of the last row wanted is found by counting, so only ``n`` rows and those that tie with the last one
    are ordered.  ``df`` is read twice, once for the scores alone, which are stored for the counts: three counts over ``df``
    itself would each compute it, and inline the score some dozens of times.
    """
    keys = list(keys)
    scored = df.withColumn("__score", score if score is not None else key_hash(seed, *keys))
    scores = stored(scored.select("__score"), "scores")
    last = order_statistics(scores, "__score", F.filter(F.array(F.least(F.col("n"), F.lit(n)) - 1), lambda r: r >= 0))
    return scored.where(F.col("__score") <= last.select("__score").scalar()).orderBy("__score", *keys).limit(n).drop("__score")


def held_out_column(
    holdout: float, keys: Iterable[str] = ("ba", "ts_unix"), seed: int = SEED, score: Column | None = None
) -> Column:
    """Whether :func:`split_by_key` holds a row out."""
    return _below(holdout, seed, keys, score)


def split_by_key(
    df: DataFrame, holdout: float, keys: Iterable[str] = ("ba", "ts_unix"), seed: int = SEED, score: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Training and hold-out rows; about ``holdout`` of the rows are held out."""
    held = held_out_column(holdout, keys, seed, score)
    return df.where(~held), df.where(held)


def split_by_time(df: DataFrame, holdout: float, time: str = "ts_unix") -> tuple[DataFrame, DataFrame]:
    """The latest part of the time range held out, so that no neighbouring hours leak across."""
    span = df.agg((F.max(time) - (F.max(time) - F.min(time)) * holdout).alias("cut"))
    return df.where(F.col(time) <= span.scalar()), df.where(F.col(time) > span.scalar())


def _scored(df: DataFrame, label: str, keys: Iterable[str], seed: int, score: Column | None) -> DataFrame:
    return df.where(F.col(label).isNotNull()).withColumn("__score", score if score is not None else key_hash(seed, *keys))


def holdout_cuts(
    df: DataFrame,
    label: str,
    holdout: float,
    keys: Iterable[str] = ("ba", "ts_unix"),
    seed: int = SEED,
    score: Column | None = None,
) -> DataFrame:
    """``(label, __cut)``: the key hash at rank ``round(holdout * n)`` of each class, found by counting and kept.

    Reads only keys and label of ``df``, three times.
    """
    wanted = F.floor(F.col("n") * holdout + 0.5)
    cuts = order_statistics(_scored(df, label, keys, seed, score), "__score", F.filter(F.array(wanted - 1), lambda r: r >= 0), [label])
    return durable(cuts.select(label, F.col("__score").alias("__cut")))


def mark_holdout(
    df: DataFrame,
    label: str,
    holdout: float,
    keys: Iterable[str] = ("ba", "ts_unix"),
    seed: int = SEED,
    score: Column | None = None,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus ``held_out``: in each class the share ``holdout`` with the smallest key hash.

    No class is sorted in one task.  Rows without a label are dropped.  ``cuts`` are those of :func:`holdout_cuts`
    for the same rows, if they are known.
    """
    cuts = holdout_cuts(df, label, holdout, keys, seed, score) if cuts is None else cuts
    scored = _scored(df, label, keys, seed, score)
    marked = scored.join(F.broadcast(cuts) if is_small(cuts) else cuts, label, "left")
    return marked.select(*df.columns, F.coalesce(F.col("__score") <= F.col("__cut"), F.lit(False)).alias("held_out"))


def split_stratified(
    df: DataFrame,
    label: str,
    holdout: float,
    keys: Iterable[str] = ("ba", "ts_unix"),
    seed: int = SEED,
    score: Column | None = None,
    cuts: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    marked = mark_holdout(df, label, holdout, keys, seed, score, cuts)
    return marked.where(~F.col("held_out")).drop("held_out"), marked.where("held_out").drop("held_out")
