"""Joins: scores to rows, events to rows, forecasts to what happened."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators.neighbours import BLOCK_DAYS

_MICROS_PER_DAY = 86_400_000_000


def attach_scores(panel: DataFrame, scores: DataFrame) -> DataFrame:
    """Every panel row, with the score of the sequence that ends in its hour or null."""
    return panel.join(scores, ["ba", "ts_unix"], "left")


def _block(micros: Column, block_days: int) -> Column:
    return F.floor(micros / (block_days * _MICROS_PER_DAY))


def events_by_block(events: DataFrame, block_days: int = BLOCK_DAYS) -> DataFrame:
    """``(ba, block, first, last, name)``: a row for every block of days that an event touches; ends are microseconds."""
    ends = events.select(
        "ba", F.unix_micros(F.col("start").cast("timestamp")).alias("first"), F.unix_micros(F.col("end").cast("timestamp")).alias("last"), "name"
    )
    touched = F.sequence(_block(F.col("first"), block_days), _block(F.col("last"), block_days))
    return ends.where("first <= last").select("ba", F.explode(touched).alias("block"), "first", "last", "name")


def _sweep(closed: bool):
    """The hours of a block that lie inside its events, found by the ends among the sorted hours.

    An event that began in an earlier block is open when the block begins, and one that goes on is open at its end.
    """

    def meet(hours: pa.Table, events: pa.Table) -> pa.Table:
        at = np.sort(hours["at"].to_numpy())
        low = np.searchsorted(at, events["first"].to_numpy(), side="left")
        high = np.searchsorted(at, events["last"].to_numpy(), side="right" if closed else "left")
        inside = np.maximum(high - low, 0)
        event = np.repeat(np.arange(len(inside)), inside)
        hour = np.arange(len(event)) - np.repeat(np.cumsum(inside) - inside, inside) + low[event]
        return pa.table({"ba": events["ba"].take(pa.array(event)), "at": at[hour], "name": events["name"].take(pa.array(event))})

    return meet


def event_overlay(panel: DataFrame, events: DataFrame, closed: bool = True, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Panel rows with the ``name`` of every event of their series they fall into, or null.

    ``events`` has ``ba, start, end, name`` (timestamps).  Hours and events meet by series and block of days, where one
    sweep over the sorted hours finds those inside each event, so a long event is sent once a block; a row inside two events
    appears twice.  ``closed`` includes the end. Events without an end, or that end before they start, hold no row.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    hours = panel.select("ba", at.alias("at")).where("ba IS NOT NULL AND at IS NOT NULL").distinct().withColumn("block", _block(F.col("at"), block_days))
    kind, name = panel.schema["ba"].dataType.simpleString(), events.schema["name"].dataType.simpleString()
    spans = events_by_block(events, block_days)
    marks = hours.groupBy("ba", "block").cogroup(spans.groupBy("ba", "block")).applyInArrow(_sweep(closed), f"ba {kind}, at long, name {name}")
    rows, marks = panel.withColumn("__at", at).alias("rows"), marks.alias("marks")
    meets = (F.col("rows.ba") == F.col("marks.ba")) & (F.col("rows.__at") == F.col("marks.at"))
    return rows.join(marks, meets, "left").select(*[F.col(f"rows.{c}") for c in panel.columns], "marks.name")


def actual_vs_forecast(features: DataFrame, source: str, horizon: int) -> DataFrame:
    """``(ba, ts_unix, actual, forecast)``: the report page draws the value ``horizon`` hours
    ahead next to the current one.  Both are on the row, so nothing is joined."""
    return features.select(
        "ba", "ts_unix", F.col(f"{source}_mw").alias("actual"), F.col(S.lead_name(source, horizon)).alias("forecast")
    )
