import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def panel(spark):
    """Six series with long gaps: 1,200 of 4,000 hours, in clusters, and one series of a single row."""
    import random

    rng = random.Random(7)
    rows = []
    for ba in "abcdef":
        hours = sorted(rng.sample(range(4000), 1200)) if ba != "f" else [17]
        hours = [h for h in hours if (h // 300 + ord(ba)) % 3 or ba == "f"]
        for h in hours:
            value = [round(rng.uniform(-50, 500), 2) if rng.random() > 0.1 else None for _ in range(5)]
            rows.append((ba, 1_600_000_000 // 3600 * 3600 + h * 3600, *value))
    schema = "ba string, ts_unix bigint, solar_mw double, wind_mw double, demand_mw double, net_gen_mw double, interchange_mw double"
    return spark.createDataFrame(rows, schema).repartition(5).cache()
