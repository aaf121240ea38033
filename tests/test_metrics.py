import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators import metrics, reports, sampling
from hourloom.operators.alignment import event_overlay


def test_regression_metrics(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(1e6, 3, 400)
    p = y + rng.normal(0, 1, 400)
    rows = [(float(a), float(b)) for a, b in zip(y, p)] + [(None, 1.0), (1.0, None)]
    got = metrics.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    assert got.n == 400
    assert got.mae == pytest.approx(np.abs(y - p).mean())
    assert got.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert got.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


@pytest.mark.parametrize("pairs,r2", [([(1.0, 1.0), (1.0, 1.0)], 1.0), ([(1.0, 2.0), (1.0, 1.0)], 0.0), ([(None, None)], None)])
def test_r2_of_constant_or_missing_values(spark, pairs, r2):
    assert metrics.regression_metrics(spark.createDataFrame(pairs, "y double, p double"), "y", "p").first().r2 == r2


def test_classification_report_with_a_missing_class(spark):
    pairs = [(0, 0)] * 6 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] + [(3, 0)] * 2 + [(None, 0), (1, None)]
    df = spark.createDataFrame(pairs, "y int, p int")
    got = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert len(got) == 7
    assert (got["balanced"].precision, got["balanced"].recall, got["balanced"].support) == (pytest.approx(6 / 9), 6 / 8, 8)
    assert got["sev_surplus"].support == 0 and got["sev_surplus"].f1 == 0.0
    assert got["deficit"].recall == 0.0 and got["deficit"].support == 2
    assert got["accuracy"].f1 == pytest.approx(9 / 14) and got["accuracy"].support == 14
    f1 = [2 * (6 / 9) * (6 / 8) / (6 / 9 + 6 / 8), 2 * (3 / 5) * (3 / 4) / (3 / 5 + 3 / 4), 0, 0]
    assert got["macro avg"].f1 == pytest.approx(sum(f1) / 4)
    assert got["weighted avg"].f1 == pytest.approx((f1[0] * 8 + f1[1] * 4) / 14)


def test_confusion_rows_sum_to_one(spark):
    pairs = [(0, 0)] * 6 + [(0, 1)] * 2 + [(1, 3)] * 3 + [(3, 0)]
    cells = metrics.confusion_matrix(spark.createDataFrame(pairs, "y int, p int"), "y", "p")
    assert cells.count() == 16
    sums = {r.actual: r.s for r in cells.groupBy("actual").agg(F.sum("share").alias("s")).collect()}
    assert sums == {0: 1.0, 1: 1.0, 2: 0.0, 3: 1.0}


def test_heatmap_shares_sum_to_one(spark):
    rows = [(h, m, (h * m) % 5) for h in range(24) for m in (1, 2, 12) for _ in range(3)]
    df = spark.createDataFrame(rows, "hour_of_day int, month int, mismatch_label int").withColumn(
        "mismatch_label", F.when(F.col("mismatch_label") < 4, F.col("mismatch_label"))
    )
    heat = reports.mismatch_heatmap(df)
    assert heat.where("abs(share_0 + share_1 + share_2 + share_3 - 1) > 1e-9").isEmpty()
    wide = reports.heatmap_pivot(heat, 1)
    assert wide.columns == ["hour_of_day", *reports.MONTHS] and wide.where("mar IS NOT NULL").isEmpty()


def test_distribution_and_deficit_denominators(spark):
    df = spark.createDataFrame([(0,), (3,), (None,), (3,)], "mismatch_label int")
    shares = {r.mismatch_label: r.percent for r in reports.class_distribution(df).collect()}
    assert shares == {0: 25.0, 3: 50.0}
    assert reports.deficit_share(df).first().deficit_pct == 50.0
    assert [r.severity_class for r in reports.class_counts_named(df).collect()] == ["Balanced", "Deficit"]


def test_event_overlay_closed_and_open(spark):
    panel = spark.range(0, 72).selectExpr("'E' AS ba", "timestamp_seconds(id * 3600) AS ts", "id").unionByName(
        spark.range(0, 72).selectExpr("'F' AS ba", "timestamp_seconds(id * 3600) AS ts", "id")
    )
    events = spark.createDataFrame([("E", 20 * 3600, 50 * 3600, "freeze")], "ba string, a bigint, b bigint, name string").selectExpr(
        "ba", "timestamp_seconds(a) AS start", "timestamp_seconds(b) AS end", "name"
    )
    closed = event_overlay(panel, events)
    assert closed.count() == 144
    assert sorted(r.id for r in closed.where("name = 'freeze'").collect()) == list(range(20, 51))
    assert closed.where("ba = 'F' AND name IS NOT NULL").isEmpty()
    assert event_overlay(panel, events, closed=False).where("name = 'freeze'").count() == 30


def test_splits_are_stable_and_disjoint(spark, panel):
    train, held = sampling.split_by_key(panel, 0.15)
    again = sampling.split_by_key(panel.repartition(7), 0.15)[1]
    assert train.count() + held.count() == panel.count()
    assert 0.1 < held.count() / panel.count() < 0.2
    assert held.exceptAll(again.select(*held.columns)).isEmpty()
    train, held = sampling.split_by_time(panel, 0.15)
    assert train.agg(F.max("ts_unix")).first()[0] < held.agg(F.min("ts_unix")).first()[0]
    assert train.count() + held.count() == panel.count()


def test_stratified_split_has_exact_shares(spark):
    df = spark.range(1000).selectExpr("concat('b', id % 7) AS ba", "id AS ts_unix", "CASE WHEN id % 10 < 7 THEN 0 WHEN id % 10 < 9 THEN 1 WHEN id = 9 THEN 2 END AS label")
    marked = sampling.mark_holdout(df, "label", 0.15)
    got = {r.label: (r.n, r.h) for r in marked.groupBy("label").agg(F.count("*").alias("n"), F.count_if("held_out").alias("h")).collect()}
    assert got == {0: (700, 105), 1: (200, 30), 2: (1, 0)}
    train, held = sampling.split_stratified(df, "label", 0.15)
    assert (train.count(), held.count()) == (766, 135)


def test_exact_sample(spark, panel):
    chosen = sampling.sample_exact(panel, 50)
    assert chosen.count() == 50
    assert chosen.exceptAll(sampling.sample_exact(panel.repartition(3), 50)).isEmpty()
    assert sampling.sample_exact(panel, 10**6).count() == panel.count()
    assert "TakeOrderedAndProject" in chosen._jdf.queryExecution().executedPlan().toString()


def test_persistence_metrics_and_pivot(spark):
    rows = [(1.0, 2.0, *([3.0, 2.0] * 3)), (5.0, 2.0, *([None, 4.0] * 3))]
    names = ["solar_mw", "wind_mw", *[S.lead_name(s, h) for h in S.LEAD_HOURS for s in S.LEAD_SIGNALS]]
    measured = metrics.persistence_metrics(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)))
    got = {(r.source, r.horizon): (r.n, r.mae) for r in measured.collect()}
    assert got == {**{("solar", f"{h}h"): (1, 2.0) for h in S.LEAD_HOURS}, **{("wind", f"{h}h"): (2, 1.0) for h in S.LEAD_HOURS}}
    wide = metrics.metrics_pivot(measured)
    assert sorted(tuple(r) for r in wide.collect()) == [("12h", 2.0, 1.0), ("24h", 2.0, 1.0), ("6h", 2.0, 1.0)]


def test_feature_lists():
    assert len(S.forecast_features()) == 169 and len(S.severity_features()) == 173
    assert "mismatch_pct" not in S.severity_features(exclude_label_source=True)
    assert S.available(["a", "b", "a", "c"], ["c", "a"]) == ["a", "c"]
