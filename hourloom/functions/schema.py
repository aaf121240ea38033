"""Column names, types and feature lists of the panel."""

from __future__ import annotations

from pyspark.sql import types as T

# Published column headers of the raw files, by canonical name.
SOURCE_HEADERS = {
    "ts_utc": "UTC Time at End of Hour",
    "ba": "Balancing Authority",
    "demand_mw": "Demand (MW) (Adjusted)",
    "demand_forecast_mw": "Demand Forecast (MW)",
    "net_gen_mw": "Net Generation (MW) (Adjusted)",
    "interchange_mw": "Total Interchange (MW) (Adjusted)",
    "coal_mw": "Net Generation (MW) from Coal (Adjusted)",
    "gas_mw": "Net Generation (MW) from Natural Gas (Adjusted)",
    "nuclear_mw": "Net Generation (MW) from Nuclear (Adjusted)",
    "oil_mw": "Net Generation (MW) from All Petroleum Products (Adjusted)",
    "hydro_mw": "Net Generation (MW) from Hydropower and Pumped Storage (Adjusted)",
    "solar_mw": "Net Generation (MW) from Solar (Adjusted)",
    "wind_mw": "Net Generation (MW) from Wind (Adjusted)",
    "other_mw": "Net Generation (MW) from Other Fuel Sources (Adjusted)",
    "unknown_mw": "Net Generation (MW) from Unknown Fuel Sources (Adjusted)",
}
# Name of a raw file, and the format of its time column.
RAW_FILE_NAME = "EIA930_BALANCE_%d_%s.csv"
RAW_FILE_GLOB = "EIA930_BALANCE_*.csv"
HALF_YEARS = ("Jan_Jun", "Jul_Dec")
TIMESTAMP_FORMATS = ("MM/dd/yyyy h:mm:ss a", "M/d/yyyy h:mm:ss a")
# A file below one MiB is an error page and no data.
MIN_VALID_BYTES = 1024 * 1024

KEYS = ("ts_utc", "ba")
SIGNALS = tuple(name for name in SOURCE_HEADERS if name not in KEYS)
# Fuels in which a missing value means no generation; the other signals keep their nulls.
ZERO_FILLED = ("solar_mw", "wind_mw", "coal_mw", "gas_mw", "nuclear_mw", "oil_mw", "hydro_mw", "other_mw")

# Windows, horizons and classes of the feature table.
HISTORY_SIGNALS = ("solar", "wind", "demand")
LAG_HOURS = tuple(range(1, 49))
ROLLING_HOURS = {"6h": 6, "24h": 24, "7d": 168}
LEAD_SIGNALS = ("solar", "wind")
LEAD_HOURS = (6, 12, 24)
CLASS_NAMES = {0: "Balanced", 1: "Mod Surplus", 2: "Sev Surplus", 3: "Deficit"}
REPORT_CLASS_NAMES = {0: "balanced", 1: "mod_surplus", 2: "sev_surplus", 3: "deficit"}
SEQUENCE_SIGNALS = ("solar_mw", "wind_mw", "demand_mw", "net_gen_mw", "interchange_mw")
SEQUENCE_HOURS = 168

CALENDAR = ("year", "month", "day_of_week", "hour_of_day", "week_of_year")


def lag_name(signal: str, hours: int) -> str:
    return f"{signal}_lag_{hours}h"


def rolling_name(signal: str, window: str, statistic: str) -> str:
    return f"{signal}_roll{window}_{statistic}"


def lead_name(signal: str, hours: int) -> str:
    return f"{signal}_t{hours}h_ahead"


LAG_COLUMNS = [lag_name(s, h) for s in HISTORY_SIGNALS for h in LAG_HOURS]
ROLLING_COLUMNS = [
    rolling_name(s, w, stat) for s in HISTORY_SIGNALS for w in ROLLING_HOURS for stat in ("mean", "std")
]
LEAD_COLUMNS = [lead_name(s, h) for h in LEAD_HOURS for s in LEAD_SIGNALS]
MISMATCH_COLUMNS = ["mismatch_mw", "mismatch_pct", "mismatch_label"]


def _history_features() -> list[str]:
    return LAG_COLUMNS + ROLLING_COLUMNS + ["hour_of_day", "day_of_week", "month", "week_of_year"]


def forecast_features() -> list[str]:
    """The 169 inputs of the generation forecasters, in order."""
    return _history_features() + [f"{s}_mw" for s in HISTORY_SIGNALS]


def severity_features(exclude_label_source: bool = False) -> list[str]:
    """The 173 inputs of the severity classifier, in order.

    The label is a function of ``mismatch_pct``, so with the full list the model can read its
    own answer.  ``exclude_label_source`` leaves the mismatch columns and net generation out.
    """
    current = [f"{s}_mw" for s in HISTORY_SIGNALS]
    if not exclude_label_source:
        current += ["net_gen_mw", "interchange_mw", "mismatch_mw", "mismatch_pct"]
    return _history_features() + current


def available(wanted, columns) -> list[str]:
    """``wanted`` without repeats and without names missing from ``columns``; order is kept."""
    present = set(columns)
    return [name for name in dict.fromkeys(wanted) if name in present]


PANEL_SCHEMA = T.StructType(
    [
        T.StructField("ba", T.StringType()),
        T.StructField("ts_utc", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("ts_unix", T.LongType()),
    ]
    + [T.StructField(name, T.IntegerType()) for name in CALENDAR]
    + [T.StructField(name, T.DoubleType()) for name in SIGNALS]
)
