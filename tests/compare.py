"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        if Path(sf_dir, f"{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return repr(value) if not isinstance(value, int) or isinstance(value, bool) else repr(int(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str:
    """Empty if both give the same columns and rows, else what differs."""
    ours = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    left, right = _rows(df.columns, ours), _rows(names, cursor.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}" if wrong else ""


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(sf_dir)
    for name, function in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = function(spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            result = (differences(df, con, sql) or f"same ({df.count()} rows)") if sql else f"rows only ({df.count()})"
        except Exception as error:  # report every query, not just the first that fails
            result = f"ERROR {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.1f}s  {result}", flush=True)
