"""The clustered layout and stored sketches."""

import glob
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hourloom.operators import reports, sketches
from hourloom.plans import anomaly
from hourloom.session import durable
from hourloom.sources import tables

HOUR = 3600
YEAR = 1_577_836_800  # 2020-01-01


@pytest.fixture(scope="module")
def table(spark):
    """300 series with an hour in five of two years."""
    rows = spark.range(300 * 3500).selectExpr("concat('S', id % 300) AS ba", f"{YEAR} + (id DIV 300) * 5 * {HOUR} AS ts_unix", "rand(7) AS v")
    return durable(rows.withColumn("year", F.year(F.timestamp_seconds("ts_unix"))))


def _scanned(df):
    """Rows that leave the scan, after row groups were left out by statistics and Bloom filters."""
    count = len(df.collect())
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return count, leaf.metrics().apply("numOutputRows").value()


def test_clustered_layout(spark, table, tmp_path):
    path = str(tmp_path / "t")
    tables.write_interleaved(table, path, row_group_bytes=1 << 14)
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"year=2020", "year=2021"}
    back = tables.load(spark, path)
    assert back.count() == table.count() and back.exceptAll(table.select(back.columns)).isEmpty()
    start = YEAR + 100 * 86_400
    week = reports.filter_entities(back, ["S17"]).where(F.col("ts_unix").between(start, start + 7 * 86_400) & (F.col("year") == 2020))
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ba,S17)" in plan and "GreaterThanOrEqual(ts_unix" in plan and "PartitionFilters: [isnotnull(year" in plan
    rows, scanned = _scanned(week)
    assert 30 <= rows <= 40 and scanned < table.count() / 20
    groups = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/year=2020/*.parquet")]
    stats = [m.row_group(i).column(1).statistics for m in groups for i in range(m.num_row_groups)]
    spans = [s.max - s.min for s in stats]
    assert len(stats) > 20 and np.median(spans) < 366 * 86_400 / 4
    # a series that is nowhere is ruled out by the filters alone
    assert _scanned(back.where("ba = 'S1x'"))[1] < table.count() / 20


def test_layout_names(spark, table, tmp_path):
    few = table.where("ba IN ('S1', 'S2')")
    tables.write_layout(few, str(tmp_path / "p"))
    assert {p.name for p in (tmp_path / "p" / "year=2020").iterdir() if p.is_dir()} == {"ba=S1", "ba=S2"}
    tables.write_layout(few, str(tmp_path / "c"), "clustered")
    assert tables.load(spark, str(tmp_path / "c")).count() == few.count()
    with pytest.raises(ValueError):
        tables.write_layout(few, str(tmp_path / "x"), "other")


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(5)
    rows = [(rng.choice("aab"), YEAR + rng.randint(0, 900) * 86_400, rng.lognormvariate(0, 1)) for _ in range(30_000)]
    rows += [("a", YEAR, None), ("b", YEAR, float("nan")), ("none", YEAR, None)]
    return durable(spark.createDataFrame(rows, "ba string, ts_unix bigint, anomaly_score double"))


def _off(values, threshold, share):
    """How far the threshold's rank is from the wanted one, as a share of n."""
    values = np.sort(values)
    low, high = np.searchsorted(values, threshold, "left"), np.searchsorted(values, threshold, "right")
    return max(low - share * len(values), share * len(values) - high, 0) / len(values)


@pytest.mark.parametrize("share", [0.01, 0.5, 0.99])
def test_merged_sketches_keep_the_bound(scores, share):
    stored = durable(sketches.score_sketches(scores, size=200))
    assert {(r.ba, r.year) for r in stored.collect()} == {(b, y) for b in "ab" for y in (2020, 2021, 2022)}
    rows = [r for r in scores.collect() if r.anomaly_score is not None and not np.isnan(r.anomaly_score)]
    by_series = {r.ba: r for r in sketches.sketched_range(stored, share, ["ba"]).collect()}
    for ba in "ab":
        values = np.array([r.anomaly_score for r in rows if r.ba == ba])
        got = by_series[ba]
        assert (got.n, got.low, got.high) == (len(values), values.min(), values.max())
        assert _off(values, got.threshold, share) <= sketches.rank_error(200)
    some = sketches.sketched_range(stored.where("ba = 'a' AND year > 2020"), share).first()
    values = np.array([r.anomaly_score for r in rows if r.ba == "a" and r.ts_unix >= YEAR + 366 * 86_400])
    assert some.n == len(values) and _off(values, some.threshold, share) <= sketches.rank_error(200)


def test_histogram_from_sketches(spark, scores):
    stored = durable(sketches.score_sketches(scores))
    ours, exact = (h.orderBy("bin").collect() for h in (sketches.sketched_histogram(stored, 20), reports.histogram(scores, bins=20)))
    n = sum(r.rows for r in exact)
    assert [r.bin for r in ours] == [r.bin for r in exact] and sum(r.rows for r in ours) == n
    assert [r.low for r in ours] == pytest.approx([r.low for r in exact]) and [r.high for r in ours] == pytest.approx([r.high for r in exact])
    assert np.abs(np.cumsum([r.rows for r in ours]) - np.cumsum([r.rows for r in exact])).max() <= sketches.rank_error() * n + 1
    equal = sketches.score_sketches(spark.createDataFrame([("a", YEAR, 2.0)] * 5, "ba string, ts_unix bigint, anomaly_score double"))
    assert [r.rows for r in sketches.sketched_histogram(equal, 4).orderBy("bin").collect()] in ([5, 0, 0, 0], [0, 0, 0, 5])


def test_no_scores(scores):
    none = sketches.score_sketches(scores.where("ba = 'none'"))
    assert none.count() == 0 and sketches.sketched_range(none).count() == 0 and sketches.sketched_histogram(none).count() == 0


def test_sketches_are_stored_with_the_scores(spark, panel, tmp_path):
    complete = durable(panel.withColumn("mismatch_label", F.lit(0)))
    settings = anomaly.AnomalySettings(length=4, components=3)
    model, scales, scores, loss = anomaly.train_anomaly(complete, settings)
    anomaly.save_anomaly(model, scales, scores, str(tmp_path), loss)
    _, _, stored, threshold = anomaly.load_anomaly(spark, str(tmp_path))
    row, exact = anomaly.sketched_threshold(spark, str(tmp_path)).first(), threshold.first()
    assert (row.n, row.low, row.high) == (stored.count(), exact.low, exact.high)
    assert row.threshold == pytest.approx(exact.threshold, rel=0.2)
    one = anomaly.sketched_threshold(spark, str(tmp_path), ["a"], 2020, 2020).first()
    assert one.n == stored.where("ba = 'a' AND year(timestamp_seconds(ts_unix)) = 2020").count()
