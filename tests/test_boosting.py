"""Staged boosting against MLlib's own, against a plain version, and against itself when interrupted."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from hourloom.plans import forecast, severity
from hourloom.plans.boosting import HELD_OUT, AbsoluteLoss, Boosted, BoostSettings, SoftmaxLoss, SoftmaxModel, best_rounds, boost, restart
from hourloom.session import durable


def _table(rows, seed=1):
    """Keys, three features of few values, a label of four classes, a number, and every fifth row held out."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 8, (rows, 3)).astype(float)
    kind = np.where(x[:, 0] > 5, 3, np.where(x[:, 1] + rng.integers(0, 3, rows) > 6, 1, np.where((x[:, 2] == 2) & (x[:, 0] < 3), 2, 0)))
    return x, kind, x[:, 0] * 3 - x[:, 1] ** 2 + rng.normal(size=rows)


@pytest.fixture(scope="module")
def table(spark):
    x, kind, number = _table(400)
    rows = [(f"s{i % 3}", i, Vectors.dense(v), float(k), float(n), i % 5 == 0) for i, (v, k, n) in enumerate(zip(x, kind, number))]
    return durable(spark.createDataFrame(rows, ["ba", "ts_unix", "features", "kind", "number", HELD_OUT]).coalesce(2))


SETTINGS = BoostSettings(rounds=6, patience=50, depth=3, step=0.3, stored_every=2)


def _predictions(model, rows, name="prediction"):
    return {r.ts_unix: r[name] for r in model.transform(rows).collect()}


def test_equals_mllib_round_for_round(table):
    """With all rows, a first tree of full depth and steps of one, rounds are those of MLlib's boosting."""
    train = table.where(~F.col(HELD_OUT))
    settings = replace(SETTINGS, share_of_rows=1.0, share_of_columns=0.67)
    boosted = boost(table, "number", AbsoluteLoss(), settings)
    whole = GBTRegressor(
        labelCol="number", lossType="absolute", maxIter=6, maxDepth=3, stepSize=0.3, featureSubsetStrategy="0.67", seed=settings.seed
    ).fit(train)
    for rounds in (1, 4, 6):
        ours, theirs = boosted.models(rounds)[0], forecast.first_rounds(whole, rounds)
        assert ours.getNumTrees == rounds
        assert _predictions(ours, table) == pytest.approx(_predictions(theirs, table), rel=1e-9)
    assert boosted.losses == pytest.approx(whole.evaluateEachIteration(table.where(HELD_OUT), "absolute"), rel=1e-9)


@pytest.mark.parametrize("label,loss", [("number", AbsoluteLoss(2.0, 0)), ("kind", SoftmaxLoss(4))])
def test_goes_on_from_a_stored_state(table, tmp_path, label, loss):
    straight = boost(table, label, loss, SETTINGS)
    first = boost(table, label, loss, replace(SETTINGS, rounds=3))
    went_on = boost(table, label, loss, SETTINGS, first)
    models = first.models(3)
    for k, model in enumerate(models):
        model.write().overwrite().save(f"{tmp_path}/{k}")
    loaded = [type(m).load(f"{tmp_path}/{k}") for k, m in enumerate(models)]
    from_disk = boost(table, label, loss, SETTINGS, restart(loaded, SETTINGS.patience, first.losses))
    for state in (went_on, from_disk):
        assert len(state.rounds) == 6 and state.losses == pytest.approx(straight.losses, rel=1e-9)
        for a, b in zip(straight.models(6), state.models(6)):
            assert _predictions(a, table) == pytest.approx(_predictions(b, table), rel=1e-9)


def test_ends_when_patience_is_over(table):
    """Held-out labels that contradict the rest: each round makes them worse, so the first one stays."""
    against = table.withColumn("number", F.when(F.col(HELD_OUT), -F.col("number")).otherwise(F.col("number")))
    state = boost(against, "number", AbsoluteLoss(5.0, 0), replace(SETTINGS, rounds=40, patience=3))
    assert state.ended and len(state.rounds) == len(state.losses) == state.best + 3 < 40
    assert state.models()[0].getNumTrees == state.best == best_rounds(state.losses, 3)
    again = boost(against, "number", AbsoluteLoss(5.0, 0), replace(SETTINGS, rounds=40, patience=3), state)
    assert len(again.rounds) == len(state.rounds)


def test_without_held_out_rows_all_rounds_are_fitted(table):
    state = boost(table.withColumn(HELD_OUT, F.lit(False)), "number", AbsoluteLoss(), replace(SETTINGS, rounds=3))
    assert state.losses == [] and state.best == len(state.rounds) == 3 and not state.ended
    assert Boosted(5).best == 0


def _plain_tree(x, target, weight, depth):
    """A least-squares tree over all midpoints: a function of a matrix."""

    def spread(rows):
        mean = np.average(target[rows], weights=weight[rows])
        return (weight[rows] * (target[rows] - mean) ** 2).sum()

    def grow(rows, left):
        value = np.average(target[rows], weights=weight[rows])
        best = (1e-12, None, None)
        for j in range(x.shape[1]) if left else ():
            values = np.unique(x[rows, j])
            for cut in (values[:-1] + values[1:]) / 2:
                low, high = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
                gain = spread(rows) - spread(low) - spread(high)
                if gain > best[0] + 1e-9:
                    best = (gain, j, cut)
        if best[1] is None:
            return lambda at: np.full(len(at), value)
        _, j, cut = best
        low, high = grow(rows[x[rows, j] <= cut], left - 1), grow(rows[x[rows, j] > cut], left - 1)
        return lambda at: np.where(at[:, j] <= cut, low(at), high(at))

    return grow(np.arange(len(x)), depth)


def test_softmax_against_a_plain_version(spark):
    x, kind, _ = _table(200, seed=6)
    rows = [("s", i, Vectors.dense(v), float(k), i % 4 == 0) for i, (v, k) in enumerate(zip(x, kind))]
    df = durable(spark.createDataFrame(rows, ["ba", "ts_unix", "features", "kind", HELD_OUT]).coalesce(1))
    settings = BoostSettings(rounds=5, patience=9, depth=2, step=0.4, share_of_rows=1.0, share_of_columns=1.0, stored_every=3)
    state = boost(df, "kind", SoftmaxLoss(4), settings)
    train, margins, losses = np.arange(200) % 4 != 0, np.zeros((200, 4)), []
    for _ in range(5):
        p = np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
        steps = []
        for k in range(4):
            spread = 2 * p[:, k] * (1 - p[:, k])
            target = np.clip(((kind == k) - p[:, k]) / spread, -4, 4)
            steps.append(_plain_tree(x[train], target[train], spread[train], 2)(x))
        margins += 0.4 * np.stack(steps, axis=1)
        p = np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
        losses.append(-np.log(p[~train, kind[~train]]).mean())
    assert state.losses == pytest.approx(losses, rel=1e-6)
    model = SoftmaxModel(state.models(5))
    got = {r.ts_unix: r for r in model.transform(df).collect()}
    for i in range(200):
        assert list(got[i].probability) == pytest.approx(p[i].tolist(), rel=1e-6) and sum(got[i].probability) == pytest.approx(1)
        assert got[i].prediction == np.argmax(margins[i].round(9))


def test_softmax_severity_is_stored_whole(spark, table, tmp_path):
    rows = table.select("ba", "ts_unix", "features", F.col("kind").alias("mismatch_label"), F.col(HELD_OUT))
    state = severity.fit_softmax(rows, severity.SeveritySettings(trees=8, patience=3, depth=3, step=0.5))
    model = SoftmaxModel(state.models(), state.losses)
    predictions = severity.classify(model, rows.where(HELD_OUT))
    assert predictions.where("actual = predicted").count() > 0.7 * predictions.count()
    severity.save_severity(model, ["a", "b", "c"], predictions, str(tmp_path))
    again, names = severity.load_severity(spark, str(tmp_path))
    assert names == ["a", "b", "c"] and again.losses == pytest.approx(state.losses)
    assert severity.classify(again, rows).exceptAll(severity.classify(model, rows)).isEmpty()
    shares = severity.importances(spark, again, names)
    assert shares.count() == 3 and shares.agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_missing_class_and_single_class(spark, table):
    """Classes without rows get no chance in the end; one class alone is always predicted."""
    only = table.withColumn("kind", F.lit(2.0))
    model = SoftmaxModel(boost(only, "kind", SoftmaxLoss(4), replace(SETTINGS, rounds=2)).models())
    assert {r.prediction for r in model.transform(only).collect()} == {2.0}
    two = table.withColumn("kind", F.when(F.col("kind") > 1, 3.0).otherwise(0.0))
    model = SoftmaxModel(boost(two, "kind", SoftmaxLoss(4), replace(SETTINGS, rounds=5)).models())
    assert {r.prediction for r in model.transform(two).collect()} == {0.0, 3.0}


def test_forecaster_goes_on(spark, table, tmp_path):
    """Losses and rounds are stored with the forecasters, and more rounds follow from them."""
    rows = table.selectExpr("ba", "ts_unix", "features", "number AS solar_t6h_ahead", HELD_OUT)
    train, held_out = rows.where(~F.col(HELD_OUT)).drop(HELD_OUT), rows.where(HELD_OUT).drop(HELD_OUT)
    few = forecast.ForecastSettings(rounds=4, depth=2, step=0.3)
    model, losses = forecast.fit_forecaster(train, held_out, "solar_t6h_ahead", few)
    assert len(losses) == 4 and losses == sorted(losses, reverse=True)
    from hourloom.plans.boosting import loss_table

    told = loss_table(spark, losses).selectExpr("'solar' AS source", "'6h' AS horizon", "*")
    metrics = spark.createDataFrame([("solar", "6h", 1, 0.0, 0.0, 0.0)], "source string, horizon string, n bigint, mae double, rmse double, r2 double")
    forecast.save_forecasters({("solar", 6): model}, metrics, str(tmp_path), told)
    start = forecast.restart_forecaster(spark, str(tmp_path), "solar", 6, 50)
    more, longer = forecast.fit_forecaster(train, held_out, "solar_t6h_ahead", replace(few, rounds=7), start)
    whole = forecast.fit_forecaster(train, held_out, "solar_t6h_ahead", replace(few, rounds=7))[1]
    assert more.getNumTrees == 7 and longer == pytest.approx(whole, rel=1e-9)


def test_rows_are_stored_once_and_no_round_copies_them(table, monkeypatch):
    """Six rounds, margins kept anew after two: one table in the folder, three in memory, none left there."""
    from pyspark.sql.classic.dataframe import DataFrame

    from hourloom.plans import boosting

    written, kept, freed = [], [], []
    stored, persist, unpersist = boosting.stored_meanwhile, DataFrame.persist, DataFrame.unpersist
    monkeypatch.setattr(boosting, "stored_meanwhile", lambda df, name: written.append(name) or stored(df, name))
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(self) or persist(self, *a))
    monkeypatch.setattr(DataFrame, "unpersist", lambda self, *a: freed.append(self) or unpersist(self, *a))
    state = boost(table, "number", AbsoluteLoss(2.0, 0), SETTINGS)
    assert len(state.rounds) == len(state.losses) == 6
    assert len(written) == 1 and len(kept) == len(freed) == 3


def test_losses_are_those_of_the_models(table):
    """Margins kept from earlier rounds and the trees since then add up to what the stored model predicts."""
    state = boost(table, "number", AbsoluteLoss(2.0, 0), replace(SETTINGS, stored_every=4))
    held_out = {r.ts_unix: r.number for r in table.where(HELD_OUT).collect()}
    for rounds in range(1, 7):
        predicted = _predictions(state.models(rounds)[0], table.where(HELD_OUT))
        assert state.losses[rounds - 1] == pytest.approx(np.mean([abs(predicted[i] - held_out[i]) for i in held_out]), rel=1e-9)


def test_forecasters_read_their_inputs_once(spark, monkeypatch):
    """One matrix for all targets, each model on the rows of its own; another model's target may be an input."""
    rng = np.random.default_rng(3)
    rows = [
        ("s", i, *rng.normal(size=2).tolist(), float(i % 7), None if i % 4 == 1 else float(i % 5) if i % 50 else float("inf"))
        for i in range(300)
    ]
    features = durable(spark.createDataFrame(rows, "ba string, ts_unix bigint, a double, b double, solar_t6h_ahead double, wind_t12h_ahead double"))
    built, matrix = [], forecast.feature_matrix
    monkeypatch.setattr(forecast, "feature_matrix", lambda *a: built.append(a) or matrix(*a))
    settings = forecast.ForecastSettings(rounds=3, depth=2, split="time", holdout=0.25)
    models, metrics, losses = forecast.train_with_losses(
        features, [("solar", 6), ("wind", 12), ("solar", 6), ("wind", 24)], settings, ["a", "b", "solar_t6h_ahead"]
    )
    assert len(built) == 1 and list(models) == [("solar", 6), ("wind", 12)]
    wind = [r[1] for r in rows if r[5] is not None and r[5] < 9]
    late = sum(t > max(wind) - (max(wind) - min(wind)) * 0.25 for t in wind)
    assert {(r.source, r.horizon): r.n for r in metrics.collect()} == {("solar", "6h"): 75, ("wind", "12h"): late}
    assert losses.groupBy("source").count().collect() and losses.count() == 6
    none = forecast.train_with_losses(features, [("wind", 24)], settings, ["a"])
    assert none[0] == {} and none[1].isEmpty() and none[2].isEmpty()
