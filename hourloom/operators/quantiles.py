"""Exact order statistics that never sort or gather all values in one task.

The value of a given rank is found in three counts, each finer than the one before and limited
to the part that holds the rank: by sign, exponent and 10 bits of the mantissa, then by the
next 20 bits, then by the value itself.  A double has 52 bits of mantissa, so the last count has at
most 2^22 different values; every count is combined in the tasks before it is shuffled,
and equal values, however many, are one row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.session import durable, is_small

_COARSE = 1 << 10
_FINE = 1 << 20
_EXPONENT_SHIFT = 1100  # above 1074, the smallest exponent of a double, so that codes are positive


def _bins(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    v = F.col("__v")
    size = F.abs(v)
    exponent = F.when(size == float("inf"), _EXPONENT_SHIFT).otherwise(F.floor(F.log2(F.when(size > 0, size))))
    within = (size / F.pow(F.lit(2.0), F.col("__e")) - 1) * _COARSE
    step = F.when(size == float("inf"), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(_COARSE - 1), F.floor(within))))
    rest = F.when(size == float("inf"), 0).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(_FINE - 1), F.floor((within - F.col("__s")) * _FINE)))
    )
    sign = F.signum(v).cast("bigint")
    return (
        df.select(*by, F.col(value).cast("double").alias("__v"))
        .where(v.isNotNull() & ~F.isnan(v))
        .withColumn("__e", exponent)
        .withColumn("__s", step)
        .select(
            *by,
            "__v",
            F.when(v == 0, 0).otherwise(sign * ((F.col("__e") + _EXPONENT_SHIFT) * _COARSE + F.col("__s"))).alias("__k1"),
            F.when(v == 0, 0).otherwise(sign * rest).alias("__k2"),
        )
    )


def _running(counts: DataFrame, within: list[str], key: str) -> DataFrame:
    upto = Window.partitionBy(*within).orderBy(key) if within else Window.orderBy(key)
    return counts.withColumn("__to", F.sum("__c").over(upto)).withColumn("__from", F.col("__to") - F.col("__c"))


def _holding(counts: DataFrame, rank: str) -> Column:
    return (F.col(rank) >= F.col("__from")) & (F.col(rank) < F.col("__to"))


def order_statistics(df: DataFrame, value: str, ranks: Column, by: Iterable[str] = ()) -> DataFrame:
    """``(*by, n, rank, value)``: the values at 0-based ``ranks`` within each group.

    ``ranks`` is an array column that may use the group's size ``n``.  Null and NaN are left
    out, and so are groups with a null key.  ``df`` is read three times, the last time when the result is: store it
    first if it is costly.
    """
    by = list(by)
    source = df.dropna(subset=by) if by else df
    binned = _bins(source, value, by)

    def matching(part: DataFrame, keys: list[str]) -> DataFrame:
        parts = part.select(*keys).distinct()
        return binned.join(F.broadcast(parts) if is_small(parts) else parts, keys, "left_semi")

    coarse = _running(binned.groupBy(*by, "__k1").agg(F.count("*").alias("__c")), by, "__k1")
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    in_coarse = durable(
        coarse.withColumn("n", F.sum("__c").over(whole))
        .withColumn("rank", F.explode(F.array_distinct(ranks)))
        .where(_holding(coarse, "rank"))
        .select(*by, "__k1", "n", "rank", (F.col("rank") - F.col("__from")).alias("__r"))
    )
    keys = [*by, "__k1"]
    fine = _running(matching(in_coarse, keys).groupBy(*keys, "__k2").agg(F.count("*").alias("__c")), keys, "__k2")
    in_fine = durable(
        fine.join(in_coarse, keys)
        .where(_holding(fine, "__r"))
        .select(*keys, "__k2", "n", "rank", (F.col("__r") - F.col("__from")).alias("__r"))
    )
    keys = [*keys, "__k2"]
    exact = _running(matching(in_fine, keys).groupBy(*keys, "__v").agg(F.count("*").alias("__c")), keys, "__v")
    return exact.join(in_fine, keys).where(_holding(exact, "__r")).select(*by, "n", "rank", F.col("__v").alias(value))


def exact_quantiles(df: DataFrame, value: str, probabilities: Iterable[float], by: Iterable[str] = ()) -> DataFrame:
    """``(*by, probability, value)``, interpolated linearly between the two nearest values."""
    by = list(by)
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    position = lambda p: p * (F.col("n") - 1)
    ranks = F.concat(
        F.transform(wanted, lambda p: F.floor(position(p))),
        F.transform(wanted, lambda p: F.ceil(position(p))),
    )
    found = order_statistics(df, value, ranks, by)
    place = position(F.col("probability"))
    below = F.max(F.when(F.col("rank") == F.floor(place), F.col(value)))
    above = F.max(F.when(F.col("rank") == F.ceil(place), F.col(value)))
    share = F.first(place - F.floor(place))
    return (
        found.withColumn("probability", F.explode(wanted))
        .groupBy(*by, "probability")
        .agg(F.when(share == 0, below).otherwise(below + (above - below) * share).alias(value))
    )


def approximate_quantiles(df: DataFrame, value: str, probabilities: Iterable[float], accuracy: int = 10_000) -> DataFrame:
    """One pass; ranks are off by at most ``n / accuracy``."""
    probabilities = [float(p) for p in probabilities]
    found = df.agg(F.percentile_approx(value, probabilities, accuracy).alias("values"))
    wanted = F.array(*map(F.lit, probabilities))
    return found.select(F.inline(F.arrays_zip(wanted.alias("probability"), F.col("values").alias(value))))
