"""From raw text columns to the typed panel."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.functions.scalar import calendar_columns, parse_number, parse_timestamp


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def normalise_columns(raw: DataFrame) -> DataFrame:
    """Canonical text columns, all of them in every frame; everything else is dropped.

    A header matches its canonical name after trimming and lower-casing; columns already named
    canonically are kept.  Only the published adjusted series match, so imputed,
    unadjusted and descriptive columns disappear here.  Headers that fall on one name are merged.
    """
    wanted = {header.lower(): name for name, header in S.SOURCE_HEADERS.items()}
    found: dict[str, list[str]] = {}
    for column in raw.columns:
        name = column if column in S.SOURCE_HEADERS else wanted.get(column.strip().lower())
        if name:
            found.setdefault(name, []).append(column)
    return raw.select(
        *[
            F.coalesce(*map(_quoted, found[name])).cast("string").alias(name)
            if name in found
            else F.lit(None).cast("string").alias(name)
            for name in S.SOURCE_HEADERS
        ],
        *[_quoted(c) for c in raw.columns if c == "source_file"],
    )


def cast_signals(df: DataFrame, signals: Iterable[str] = S.SIGNALS) -> DataFrame:
    """Signals as doubles; a signal the frame lacks becomes a null column."""
    signals = list(signals)
    return df.select(
        *[c for c in df.columns if c not in signals],
        *[
            (parse_number(F.col(s)) if s in df.columns else F.lit(None).cast("double")).alias(s)
            for s in signals
        ],
    )


def reject_counts(text: DataFrame) -> DataFrame:
    """``(column, filled, rejected)``: how many non-blank texts of each column could not be read."""
    parsers = {"ts_utc": parse_timestamp, **{s: parse_number for s in S.SIGNALS}}
    checks = []
    for name in S.available(parsers, text.columns):
        filled = F.trim(F.col(name)) != ""
        checks.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count_if(filled).alias("filled"),
                F.count_if(filled & parsers[name](F.col(name)).isNull()).alias("rejected"),
            )
        )
    return text.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


def drop_missing_keys(df: DataFrame) -> DataFrame:
    return df.dropna(subset=list(S.KEYS))


def dedup_latest(df: DataFrame, keys: Iterable[str] = S.KEYS, first_by: str = "source_file") -> DataFrame:
    """One row per key: from the last file by name, and among its copies the greatest values.

    Spark keeps one row per key in each input partition before it shuffles, so a
    key with very many copies does not gather in one task.
    """
    keys = list(keys)
    order = [c for c in (first_by,) if c in df.columns] + [c for c in df.columns if c not in (*keys, first_by)]
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") == 1).drop("__rank")


def fill_fuels(df: DataFrame, fuels: Iterable[str] = S.ZERO_FILLED) -> DataFrame:
    return df.fillna(0.0, subset=list(fuels))


def add_calendar(df: DataFrame, text: str = "ts_utc") -> DataFrame:
    """Timestamp, epoch seconds and calendar parts; rows whose time cannot be read are removed."""
    timed = df.withColumn("ts", parse_timestamp(F.col(text))).where(F.col("ts").isNotNull())
    return timed.select("*", F.unix_timestamp("ts").alias("ts_unix"), *calendar_columns(F.col("ts")))


def finite_or_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Infinities and NaN become null."""
    columns = set(columns)
    infinite = float("inf")
    return df.select(
        *[
            F.when(~F.isnan(F.col(c).cast("double")) & (F.abs(c) != infinite), F.col(c)).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def complete_cases(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows with a value (not null, not NaN) in every one of ``columns``."""
    return df.dropna(subset=list(columns))


def clean_panel(text: DataFrame) -> DataFrame:
    """Canonical text rows to the typed, time-stamped panel, unique per series and hour.

    Duplicates are found by the time read, so two spellings of one hour count as one key.
    """
    timed = add_calendar(drop_missing_keys(cast_signals(text)))
    unique = dedup_latest(timed, keys=("ba", "ts_unix"))
    return fill_fuels(unique).select(*S.PANEL_SCHEMA.fieldNames())
