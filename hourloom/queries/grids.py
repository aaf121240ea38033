"""Hourly panels derived from the sample tables, as DataFrames and as SQL for the checks.

* ``event_grid``: ``events`` by type and hour; dense, few series.
* ``shipment_grid``: ``lineitem`` by supplier and hour; sparse, many series, several years.
* ``step_grid``: ``lineitem`` by supplier and day, one day being one hourly step.

Values are cut to two decimals, so sums of cents are exact and equal in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions.scalar import calendar_columns
from hourloom.operators.labels import add_labels
from hourloom.session import configure

FUELS = ("solar", "wind", "coal", "gas", "nuclear", "oil", "hydro", "other")
#: Arithmetic in place of the key hash, so that SQL picks the same rows; and the same from 0 to 1.
SCORE = "(CAST(ts_unix / 3600 AS BIGINT) * 7919 + length(ba) * 104729) % 99991"
FRACTION = f"({SCORE}) / 99991"
_AMOUNT = "CAST({value} AS DECIMAL(18,2))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A sum of cents is two BIGINTs, of whole multiples of this and of what is left: exact like a sum of DECIMALs, which on 28 digits
#: costs many times as much. Sums up to these bounds become doubles by one division of whole numbers below 2^53.
_BASE = 1 << 30
_MOST_HIGH, _MOST_LOW = 1 << 17, 1 << 47


def _sums(name: str, cents: str) -> list[Column]:
    return [F.expr(f"sum({cents.format(part)})").alias(f"{name}_{end}") for part, end in ((f"cents DIV {_BASE}", "high"), (f"cents % {_BASE}", "low"))]


def _cells(rows: DataFrame, key: str, hour: str, value: str, fuel: str) -> DataFrame:
    amount = _AMOUNT.format(value=value)
    cut = rows.selectExpr(f"{key} AS ba", f"{hour} AS ts", f"CAST({amount} * 100 AS BIGINT) AS cents", f"{fuel} % 8 AS fuel")
    fuels = [F.coalesce(total, F.lit(0)).alias(f"{f}_{end}") for i, f in enumerate(FUELS) for total, end in zip(_sums(f, f"CASE WHEN fuel = {i} THEN {{}} END"), ("high", "low"))]
    return cut.groupBy("ba", "ts").agg(F.count("*").alias("n"), *_sums("net", "{}"), *fuels)


def _double(unit: str, **times: int) -> str:
    """The nearest double to a sum of columns, each taken so many times, in units of ``0.01`` or ``0.001``."""
    small = " AND ".join(f"abs({c}_high) <= {_MOST_HIGH} AND abs({c}_low) <= {_MOST_LOW}" for c in times)
    whole = " + ".join(f"{k} * ({c}_high * {_BASE} + {c}_low)" for c, k in times.items())
    wide = " + ".join(f"{k} * (CAST({c}_high AS DECIMAL(19,0)) * {_BASE} + CAST({c}_low AS DECIMAL(19,0)))" for c, k in times.items())
    return f"CASE WHEN {small} THEN ({whole}) / {round(1 / float(unit))}D ELSE CAST(({wide}) * {unit} AS DOUBLE) END"


def _signals(cells: DataFrame, least_rows: int) -> DataFrame:
    return cells.select(
        "ba",
        "ts",
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("ts_unix"),
        F.expr(f"CASE WHEN n >= {least_rows} THEN {_double('0.001', net=10, other=2, solar=-2)} END").alias("demand_mw"),
        F.expr(_double("0.01", net=1)).alias("net_gen_mw"),
        F.expr(_double("0.001", solar=2, other=-2)).alias("interchange_mw"),
        *[F.expr(_double("0.01", **{f: 1})).alias(f"{f}_mw") for f in FUELS],
    )


def _cells_sql(source: str, key: str, hour: str, value: str, fuel: str, least_rows: int, unix: str = "CAST(epoch(ts) AS BIGINT)") -> str:
    amount = _AMOUNT.format(value=value)
    sums = ", ".join(
        f"coalesce(sum(CASE WHEN {fuel} % 8 = {i} THEN {amount} END), 0) AS {f}" for i, f in enumerate(FUELS)
    )
    fuels = ", ".join(f"CAST({f} AS DOUBLE) AS {f}_mw" for f in FUELS)
    return f"""
WITH cells AS (
  SELECT {key} AS ba, {hour} AS ts, count(*) AS n, sum({amount}) AS net, {sums}
  FROM {source} GROUP BY 1, 2),
grid AS (
  SELECT ba, ts, {unix} AS ts_unix,
         CAST(CASE WHEN n >= {least_rows} THEN net + 0.2 * other - 0.2 * solar END AS DOUBLE) AS demand_mw,
         CAST(net AS DOUBLE) AS net_gen_mw,
         CAST(0.2 * solar - 0.2 * other AS DOUBLE) AS interchange_mw, {fuels}
  FROM cells),
labelled AS (
  SELECT *, net_gen_mw - demand_mw AS mismatch_mw,
         CASE WHEN demand_mw <> 0 THEN (net_gen_mw - demand_mw) / demand_mw * 100 END AS mismatch_pct
  FROM grid),
panel AS (
  SELECT *, CASE WHEN mismatch_pct IS NULL THEN NULL WHEN mismatch_pct < -5 THEN 3
                 WHEN mismatch_pct > 20 THEN 2 WHEN mismatch_pct > 5 THEN 1 ELSE 0 END AS mismatch_label,
         CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
         CAST(dayofweek(ts) + 1 AS INT) AS day_of_week, CAST(hour(ts) AS INT) AS hour_of_day,
         CAST(weekofyear(ts) AS INT) AS week_of_year
  FROM labelled)"""


def _finish(grid: DataFrame) -> DataFrame:
    return add_labels(grid).select("*", *calendar_columns(F.col("ts")))


def event_grid(spark: SparkSession, sf_dir: str, least_rows: int = 2) -> DataFrame:
    """Hours with fewer than ``least_rows`` events have no demand."""
    events = table(spark, sf_dir, "events")
    return _finish(_signals(_cells(events, "event_type", "date_trunc('HOUR', ts)", "value", "user_id"), least_rows))


def event_sql(least_rows: int = 2) -> str:
    return _cells_sql("events", "event_type", "date_trunc('hour', ts)", "value", "user_id", least_rows)


EVENT_SQL = event_sql()

_SUPPLIER = "concat('S', CAST(l_suppkey AS {text}))"


def shipment_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    hour = "l_shipdate + make_dt_interval(0, CAST(l_orderkey % 24 AS INT))"
    return _finish(_signals(_cells(lines, _SUPPLIER.format(text="STRING"), hour, "l_quantity", "l_partkey"), 1))


SHIPMENT_SQL = _cells_sql(
    "lineitem",
    _SUPPLIER.format(text="VARCHAR"),
    "l_shipdate + to_hours(CAST(l_orderkey % 24 AS INT))",
    "l_quantity",
    "l_partkey",
    1,
)


def step_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    cells = _cells(lines, _SUPPLIER.format(text="STRING"), "date_trunc('DAY', l_shipdate)", "l_quantity", "l_partkey")
    stepped = _signals(cells, 1).withColumn("ts_unix", F.expr("CAST(ts_unix / 24 AS BIGINT)"))
    return _finish(stepped)


STEP_SQL = _cells_sql(
    "lineitem",
    _SUPPLIER.format(text="VARCHAR"),
    "date_trunc('day', l_shipdate)",
    "l_quantity",
    "l_partkey",
    1,
    "CAST(epoch(ts) / 24 AS BIGINT)",
)
