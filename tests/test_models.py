import os
from dataclasses import replace

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from hourloom.operators.labels import add_labels
from hourloom.operators.windows import add_leads
from hourloom.plans import anomaly, forecast, severity
from hourloom.session import checkpoint_dir, durable, stored_meanwhile


@pytest.fixture(scope="module")
def features(spark):
    """A daily wave with demand that follows it loosely; 700 hours of two series."""
    hours = spark.range(1400).selectExpr("concat('s', id % 2) AS ba", "(id DIV 2) * 3600 AS ts_unix", "id % 2 AS k", "id DIV 2 AS h")
    noise = (F.xxhash64("ba", "ts_unix") % 1000) / 1000.0
    wave = F.sin(F.col("h") * 2 * 3.141592653589793 / 24)
    panel = hours.select(
        "ba",
        "ts_unix",
        (100 + 80 * wave + 5 * noise).alias("solar_mw"),
        (60 + 20 * F.cos(F.col("h") / 9.0)).alias("wind_mw"),
        (250 + 30 * wave + F.col("k")).alias("demand_mw"),
        (250 + 60 * wave + 10 * noise).alias("net_gen_mw"),
        (noise * 2).alias("interchange_mw"),
    )
    return durable(add_labels(add_leads(panel)))


INPUTS = ["solar_mw", "wind_mw", "demand_mw"]
FAST = forecast.ForecastSettings(rounds=6, patience=2, depth=3, step=0.3)


def test_forecasters(spark, features, tmp_path):
    models, metrics = forecast.train_forecasters(features, [("solar", 24), ("wind", 6)], FAST, INPUTS)
    rows = {(r.source, r.horizon): r for r in metrics.collect()}
    assert set(rows) == {("solar", "24h"), ("wind", "6h")}
    assert rows["solar", "24h"].r2 > 0.9 and rows["solar", "24h"].n > 100
    forecast.save_forecasters(models, metrics, str(tmp_path))
    again = forecast.load_forecaster(str(tmp_path), "solar", 24)
    sample = forecast.compare_on_sample(again, features, "solar_t24h_ahead", 50, INPUTS)
    assert sample.count() == 50 and sample.where("prediction IS NULL OR actual IS NULL").isEmpty()
    assert forecast.load_metrics(spark, str(tmp_path)).count() == 2


def test_time_split_and_missing_targets(features):
    settings = forecast.ForecastSettings(rounds=2, depth=2, split="time")
    models, metrics = forecast.train_forecasters(features.drop("wind_t6h_ahead"), [("solar", 6), ("wind", 6)], settings, INPUTS)
    assert list(models) == [("solar", 6)] and metrics.first().n > 0


def test_no_complete_rows_gives_no_models(features):
    models, metrics = forecast.train_forecasters(features.withColumn("wind_mw", F.lit(None).cast("double")), settings=FAST, inputs=INPUTS)
    assert models == {} and metrics.count() == 0


def test_best_rounds():
    assert forecast.best_rounds([5, 4, 3, 4, 5, 6], 2) == 3
    assert forecast.best_rounds([5, 4, 4.5, 4.6, 1], 2) == 2
    assert forecast.best_rounds([5, 4, 4.5, 4.6, 1], 9) == 5


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_severity(spark, features, tmp_path, kind):
    settings = severity.SeveritySettings(trees=5, depth=4, kind=kind)
    inputs = [*INPUTS, "net_gen_mw", "mismatch_pct"]
    model, used, predictions = severity.train_severity(features, settings, inputs)
    assert predictions.where("actual = predicted").count() / predictions.count() > 0.9
    severity.save_severity(model, used, predictions, str(tmp_path))
    again, names = severity.load_severity(spark, str(tmp_path), kind)
    assert names == inputs
    matrix, _ = severity.severity_matrix(features, settings, names)
    assert severity.classify(again, matrix).count() == features.where("mismatch_label IS NOT NULL").count()
    if kind == "forest":
        top = severity.top_importances(spark, again, names, 2).collect()
        assert len(top) == 2 and top[0].importance >= top[1].importance
        assert severity.importances(spark, again, names).agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_anomaly(spark, features, tmp_path):
    settings = anomaly.AnomalySettings(length=6, components=4)
    model, scales, scores, loss = anomaly.train_anomaly(features, settings)
    assert scores.count() == 2 * (700 - 5)
    assert scores.where("anomaly_score < 0").isEmpty() and loss.first().loss >= 0
    anomaly.save_anomaly(model, scales, scores, str(tmp_path))
    _, _, stored, threshold = anomaly.load_anomaly(spark, str(tmp_path))
    row = threshold.first()
    assert row.low <= row.threshold <= row.high
    assert stored.where(F.col("anomaly_score") > row.threshold).count() == 14


def test_all_components_rebuild_everything(features):
    scores = anomaly.train_anomaly(features, anomaly.AnomalySettings(length=3, components=15))[2]
    assert scores.agg(F.max("anomaly_score")).first()[0] < 1e-9


def test_reconstruction_error_by_hand(spark):
    rows = [(f"s{i}", i, Vectors.dense([float(i), 2.0 * i, 0, 0, 0])) for i in range(6)] + [("odd", 9, Vectors.dense([0, 0, 10.0, 0, 0]))]
    df = spark.createDataFrame(rows, ["ba", "ts_unix", "sequence"])
    settings = anomaly.AnomalySettings(length=1, components=1)
    model = anomaly.fit_reconstruction(df.where("ba <> 'odd'"), settings)
    got = {r.ba: r.anomaly_score for r in anomaly.reconstruction_error(model, df, settings).collect()}
    assert max(v for k, v in got.items() if k != "odd") < 1e-12
    assert got["odd"] == pytest.approx(100 / 5)


def test_too_few_normal_hours_gives_no_scores(features):
    model, _, scores, loss = anomaly.train_anomaly(features.limit(20), anomaly.AnomalySettings(length=30))
    assert model is None and scores.count() == 0 and loss.count() == 0


def test_constant_signal_is_not_divided_by_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "solar_mw double")
    assert [r.solar_mw for r in anomaly.standardise(df, anomaly.signal_scales(df, ["solar_mw"]), ["solar_mw"]).collect()] == [0.0, 0.0]


def test_durable_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", "")
    assert named in checkpoint_dir(spark)
    assert durable(spark.range(3)).count() == 3


@pytest.mark.parametrize("rounds", [1, 3, 6])
def test_cut_model_equals_a_fit_of_fewer_rounds(features, rounds):
    rows = features.where("solar_t6h_ahead IS NOT NULL")
    rows = forecast.feature_matrix(rows, INPUTS, ["solar_t6h_ahead"])
    cut = forecast.first_rounds(forecast._regressor("solar_t6h_ahead", FAST).fit(rows), rounds)
    fewer = forecast._regressor("solar_t6h_ahead", replace(FAST, rounds=rounds)).fit(rows)
    assert cut.getNumTrees == rounds and cut.numFeatures == 3
    pairs = fewer.transform(rows).select("ba", "ts_unix", F.col("prediction").alias("p")).join(cut.transform(rows), ["ba", "ts_unix"])
    assert pairs.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-9


def test_boosting_stops_by_itself(features):
    settings = replace(FAST, rounds=60, stop_early=True)
    # six hours ahead the inputs do not tell whether the wave rises or falls, so there is soon nothing to gain
    models, metrics = forecast.train_forecasters(features, [("solar", 6)], settings, INPUTS)
    assert 1 <= models["solar", 6].getNumTrees < 60 and metrics.first().n > 100


def test_stored_table_goes_at_the_end(spark):
    with stored_meanwhile(spark.range(5), "some") as table:
        path = table.inputFiles()[0].removeprefix("file:")
        assert table.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)


def test_kind_and_importances_of_the_boosted_classifier(spark, features, tmp_path):
    settings = severity.SeveritySettings(trees=3, depth=3, kind="boosted")
    model, used, predictions = severity.train_severity(features, settings, INPUTS)
    severity.save_severity(model, used, predictions, str(tmp_path))
    again, names = severity.load_severity(spark, str(tmp_path))
    rows = severity.importances(spark, again, names)
    assert names == INPUTS and rows.count() == 3 and rows.agg(F.sum("importance")).first()[0] == pytest.approx(1)
