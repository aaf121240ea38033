"""Supply and demand mismatch of each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions.scalar import mismatch_pct, severity_label
from hourloom.session import durable


def label_columns() -> list[Column]:
    generation, demand = F.col("net_gen_mw"), F.col("demand_mw")
    pct = mismatch_pct(generation, demand)
    return [
        (generation - demand).alias("mismatch_mw"),
        pct.alias("mismatch_pct"),
        severity_label(pct).alias("mismatch_label"),
    ]


def add_labels(panel: DataFrame) -> DataFrame:
    return panel.select("*", *label_columns())


def entity_codes(panel: DataFrame, column: str = "ba") -> DataFrame:
    """``(column, code)``: distinct names numbered from 0 in alphabetical order.

    The distinct names are stored in ranges of their order; each range numbers its own and adds the counts of
    the ranges before, so no task sorts all names, however many share their first letters.
    """
    names = panel.select(column).where(F.col(column).isNotNull()).distinct()
    ranged = durable(names.repartitionByRange(column).withColumn("__range", F.spark_partition_id()))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("__range").agg(F.count("*").alias("n"))
    offsets = counts.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(column))
    return ranged.join(offsets, "__range").select(column, (F.col("offset") + within - 1).cast("int").alias("code"))
