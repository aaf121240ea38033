"""Events over rows by one sweep a block, against comparing every row with every event."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hourloom.operators.alignment import event_overlay, events_by_block

START = datetime(2015, 1, 1)


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("block_days", [1, 180])
def test_events_against_all_pairs(spark, closed, block_days):
    rng = random.Random(block_days)
    moment = lambda: START + timedelta(hours=rng.randint(0, 24 * 30))
    rows = [(rng.choice("abc"), moment(), i) for i in range(600)] + [(None, START, -1), ("a", None, -2), ("d", START, -3)]
    events = [(rng.choice("abce"), *sorted((moment(), moment())), f"e{i}") for i in range(40)]
    events += [("a", rows[0][1], rows[0][1], "instant"), ("a", START + timedelta(days=9), START, "backwards"), ("b", None, START, "no start"), (None, START, START, "none")]
    events += [("a", datetime(1960, 1, 1), datetime(2030, 1, 1), None), ("b", START, START + timedelta(days=3), "twice"), ("b", START, START + timedelta(days=3), "twice")]
    panel = spark.createDataFrame(rows, "ba string, ts timestamp, name int")
    table = spark.createDataFrame(events, "ba string, start timestamp, end timestamp, name string")
    got = [tuple(r) for r in event_overlay(panel, table, closed, block_days).collect()]
    want = []
    for ba, ts, i in rows:
        names = [
            n for b, s, e, n in events if ba is not None and b == ba and ts is not None and s is not None and e is not None and s <= ts and (ts <= e if closed else ts < e)
        ]
        want += [(ba, ts, i, n) for n in names] or [(ba, ts, i, None)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_long_events_are_sent_by_block(spark):
    events = spark.createDataFrame([("a", START, START + timedelta(days=3652), "decade"), ("a", START, START, "instant")], "ba string, start timestamp, end timestamp, name string")
    sent = {r.name: r["count"] for r in events_by_block(events).groupBy("name").count().collect()}
    assert sent["instant"] == 1 and 21 <= sent["decade"] <= 22


def test_no_events(spark):
    panel = spark.createDataFrame([("a", START)], "ba string, ts timestamp")
    none = spark.createDataFrame([], "ba string, start timestamp, end timestamp, name string")
    assert [tuple(r) for r in event_overlay(panel, none).collect()] == [("a", START, None)]
    assert event_overlay(panel.where(F.lit(False)), none).count() == 0
