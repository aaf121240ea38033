"""Column expressions: parsing, calendar, mismatch, stable hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourloom.functions.schema import CLASS_NAMES, TIMESTAMP_FORMATS


def parse_number(text: Column) -> Column:
    """Text to double; thousands separators are removed and what is no plain or exponent number is null."""
    plain = F.regexp_replace(F.trim(text), ",", "")
    return F.when(plain.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), plain.try_cast("double"))


def parse_timestamp(text: Column) -> Column:
    """Text to timestamp in the session zone; unreadable text is null."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(fmt)) for fmt in TIMESTAMP_FORMATS])


def calendar_columns(ts: Column) -> list[Column]:
    """Year, month, day of week (Sunday is 1), hour and ISO week."""
    return [
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofweek(ts).alias("day_of_week"),
        F.hour(ts).alias("hour_of_day"),
        F.weekofyear(ts).alias("week_of_year"),
    ]


def mismatch_pct(net_generation: Column, demand: Column) -> Column:
    """Percent by which generation exceeds demand; null for null or zero demand."""
    return F.when(demand != 0, (net_generation - demand) / demand * 100)


def severity_label(pct: Column) -> Column:
    """0 from -5 to 5 %, 1 to 20 %, 2 above, 3 below -5 %; null stays null."""
    return (
        F.when(pct < -5.0, F.lit(3))
        .when(pct <= 5.0, F.lit(0))
        .when(pct <= 20.0, F.lit(1))
        .when(pct > 20.0, F.lit(2))
    )


def label_name(label: Column, names: dict[int, str] = CLASS_NAMES) -> Column:
    expression = F.lit(None).cast("string")
    for code, name in names.items():
        expression = F.when(label == code, F.lit(name)).otherwise(expression)
    return expression


def key_hash(seed: int, *keys: Column | str) -> Column:
    """Non-negative 52-bit hash of a row key: the same row gets the same value in every run.

    52 bits survive a cast to double unchanged.
    """
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)


def key_fraction(seed: int, *keys: Column | str) -> Column:
    """The key hash as a number in [0, 1)."""
    return key_hash(seed, *keys) / F.lit(float(1 << 52))
