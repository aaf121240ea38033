"""Headline queries on the sample tables; prints one JSON line.

Panels are stored as Parquet first and not timed, since every query here reads a stored panel.  Each
query runs twice, with a sink that takes all rows, and the second run is reported; building the
plan, and every job that building starts, is part of the time.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators import metrics, reports
from hourloom.operators.cleaning import clean_panel, normalise_columns
from hourloom.operators.quantiles import exact_quantiles
from hourloom.operators.windows import add_lags, add_leads, add_rolling, feature_table, hourly_grid, sequences
from hourloom.queries.grids import event_grid, shipment_grid, step_grid
from hourloom.queries.preparation import _raw_text
from hourloom.sources.tables import load

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("hourloom-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _sequence_sums(panel: DataFrame) -> DataFrame:
    total = F.aggregate("sequence", F.lit(0.0), lambda t, x: t + x)
    return sequences(panel.dropna(subset=list(S.SEQUENCE_SIGNALS))).select("ba", "ts_unix", total.alias("total"))


def main() -> None:
    spark = _session()
    folder = tempfile.mkdtemp(prefix="hourloom-bench-")
    grids = {"event": event_grid, "shipment": shipment_grid, "step": step_grid}
    panels = {}
    for name, grid in grids.items():
        grid(spark, SF_DIR).write.parquet(f"{folder}/{name}")
        panels[name] = load(spark, f"{folder}/{name}")
    steps, shipments, events = panels["step"].drop(*S.MISMATCH_COLUMNS), panels["shipment"], panels["event"]

    headline = {
        "lag_features": lambda: add_lags(steps),
        "lag_by_time": lambda: add_lags(steps, mode="time"),
        "rolling_features": lambda: add_rolling(steps),
        "lead_targets": lambda: add_leads(steps),
        "feature_table": lambda: feature_table(steps),
        "hourly_grid": lambda: hourly_grid(events.select("ba", "ts_unix", "demand_mw")),
        "sequence_windows": lambda: _sequence_sums(steps),
        "clean_panel": lambda: clean_panel(normalise_columns(_raw_text(spark, SF_DIR))),
        "mismatch_heatmap": lambda: reports.mismatch_heatmap(shipments),
        "class_distribution": lambda: reports.class_distribution(shipments),
        "summary": lambda: reports.summary(shipments),
        "exact_quantile": lambda: exact_quantiles(shipments, "net_gen_mw", [0.99]),
        "histogram": lambda: reports.histogram(shipments, "net_gen_mw"),
        "persistence_metrics": lambda: metrics.persistence_metrics(add_leads(steps)),
    }
    seconds = {}
    for name, build in headline.items():
        for _ in range(2):
            start = time.time()
            _run(build())
            seconds[name] = round(time.time() - start, 3)
    rows = steps.count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "feature_rows": rows,
                "feature_rows_per_sec": round(rows / seconds["feature_table"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
