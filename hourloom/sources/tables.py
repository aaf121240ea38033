"""Parquet tables: the panel, the feature table, anomaly scores."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.functions.schema import available


def load(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """A Parquet table, limited to those of ``columns`` that it has; only these are read.

    Series names that look like numbers stay text: in a partitioned table Spark would take them
    for numbers and lose leading zeros.
    """
    df = spark.read.parquet(path)
    fields = [T.StructField(f.name, T.StringType()) if f.name == "ba" else f for f in df.schema.fields]
    if fields != df.schema.fields:
        df = spark.read.schema(T.StructType(fields)).parquet(path)
    return df if columns is None else df.select(*available(columns, df.columns))


def write_partitioned(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with files by year and series.

    Rows of one year and series are brought together, so a directory gets few files; a
    directory much larger than the others is split over several tasks while it runs.
    """
    df.hint("rebalance", "year", "ba").write.mode("overwrite").partitionBy("year", "ba").parquet(path)


def write_clustered(df: DataFrame, path: str) -> None:
    """The same layout without a shuffle, for a table whose rows already lie together by series and
    time, as they do after :func:`hourloom.operators.windows.feature_table`."""
    df.write.mode("overwrite").partitionBy("year", "ba").parquet(path)


#: Bits of series and of time in the interleaved key, and bytes of a row group.
_KEY_BITS, _ROW_GROUP = 12, 16 << 20


def interleaved_key(series: str = "ba", time: str = "ts_unix") -> Column:
    """Bits of the series' hash and of the day in its year in turns: rows of near keys share both series and days."""
    days = F.expr(f"CAST(pmod(floor({time} / 86400), {1 << _KEY_BITS}) AS BIGINT)")
    names = F.pmod(F.xxhash64(series), F.lit(1 << _KEY_BITS))
    key = F.lit(0).cast("long")
    for bit in range(_KEY_BITS):
        for offset, part in ((1, names), (0, days)):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(part, bit).bitwiseAND(F.lit(1)), 2 * bit + offset))
    return key


def write_interleaved(df: DataFrame, path: str, row_group_bytes: int = _ROW_GROUP) -> None:
    """Overwrite ``path`` with files by year alone, for very many series: directories do not grow with them.

    Rows are ranged by year and an interleaved key of series and time, so a row group holds few series and a short stretch. The least
    and greatest times tell which row groups a time range needs, and Bloom filters which ones hold a series.
    """
    key = "__key"
    ranged = df.withColumn(key, interleaved_key()).repartitionByRange("year", key).sortWithinPartitions("year", key, "ba", "ts_unix").drop(key)
    options = {"parquet.bloom.filter.enabled#ba": "true", "parquet.block.size": str(row_group_bytes)}
    ranged.write.mode("overwrite").options(**options).partitionBy("year").parquet(path)


def write_layout(df: DataFrame, path: str, layout: str = "partitioned") -> None:
    """``partitioned``: directories by year and series; ``clustered``: by year, clustered by series and time."""
    if layout == "partitioned":
        write_clustered(df, path)
    elif layout == "clustered":
        write_interleaved(df, path)
    else:
        raise ValueError(f"layout must be 'partitioned' or 'clustered', got {layout!r}")


def write_scores(scores: DataFrame, path: str) -> None:
    """``(ba, ts_unix, anomaly_score)`` without null scores."""
    kept = scores.where(F.col("anomaly_score").isNotNull())
    kept.select("ba", "ts_unix", "anomaly_score").write.mode("overwrite").parquet(path)
