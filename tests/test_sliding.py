"""Sliding windows from single rows, against windows that are written out."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators import sliding
from hourloom.operators.sampling import held_out_column, split_by_key
from hourloom.operators.windows import sequences
from hourloom.plans import anomaly
from hourloom.session import durable


@pytest.mark.parametrize("n,low,length", [(40, 9, 10), (40, 20, 7), (12, 11, 12), (30, 29, 1), (30, 0, 1)])
def test_lagged_products_by_hand(n, low, length):
    x = np.random.default_rng(n).normal(size=(n, 3))
    windows = np.array([x[t - length + 1 : t + 1].ravel() for t in range(low, n)])
    assert np.abs(sliding.lagged_products(x, low, n, length) - windows.T @ windows).max() < 1e-11
    assert np.abs(sliding._window_sums(x, low, n, length) - windows.sum(axis=0)).max() < 1e-11


@pytest.fixture(scope="module")
def complete(panel):
    return durable(panel.dropna(subset=list(S.SEQUENCE_SIGNALS)).where("ba <> 'b' OR ts_unix % 7200 = 0"))


@pytest.mark.parametrize("contiguous", [False, True])
@pytest.mark.parametrize("share", [0.1, 0.8])
@pytest.mark.parametrize("block_days", [3, 180])
def test_moments_equal_those_of_arrays(complete, contiguous, share, block_days):
    """Blocks, gaps, few or many windows that do not count, and series shorter than a window."""
    length = 6 if not contiguous else 3
    keep = ~held_out_column(share)
    n, mean, covariance = sliding.window_moments(complete, S.SEQUENCE_SIGNALS, length, keep, contiguous, block_days)
    arrays = split_by_key(sequences(complete, length=length, contiguous=contiguous), share)[0]
    x = np.array([r.sequence for r in arrays.collect()])
    assert n == len(x) > 5
    assert mean == pytest.approx(x.mean(axis=0), rel=1e-9)
    assert np.abs(covariance - np.cov(x.T)).max() < 1e-9 * np.abs(covariance).max()


@pytest.mark.parametrize("contiguous", [False, True])
def test_errors_equal_those_of_arrays(complete, contiguous):
    length, rng = 4, np.random.default_rng(3)
    width = length * len(S.SEQUENCE_SIGNALS)
    scaled = anomaly.standardise(complete, anomaly.signal_scales(complete))
    mean, components = rng.normal(size=width), np.linalg.qr(rng.normal(size=(width, 7)))[0]
    got = {(r.ba, r.ts_unix): r.error for r in sliding.projection_errors(scaled, S.SEQUENCE_SIGNALS, length, mean, components, contiguous, 4).collect()}
    want = {}
    for r in sequences(scaled, length=length, contiguous=contiguous).collect():
        x = np.array(r.sequence) - mean
        want[r.ba, r.ts_unix] = (x @ x - ((x @ components) ** 2).sum()) / width
    assert got.keys() == want.keys() and len(got) > 5
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_anomaly_equals_the_array_version(complete):
    """Model and scores are those of MLlib on sequences that are written out."""
    settings = anomaly.AnomalySettings(length=5, components=6)
    labelled = complete.withColumn("mismatch_label", F.when(F.col("ts_unix") % 10 < 8, 0).otherwise(1))
    model, scales, scores, loss = anomaly.train_anomaly(labelled, settings)
    scaled = anomaly.standardise(labelled, scales)
    vectors = anomaly._vectors(scaled, settings)
    normal = anomaly._vectors(scaled.where("mismatch_label = 0"), settings)
    train, held_out = split_by_key(normal, settings.holdout, seed=settings.seed)
    written = anomaly.fit_reconstruction(train, settings)
    want = {(r.ba, r.ts_unix): r.anomaly_score for r in anomaly.reconstruction_error(written, vectors, settings).collect()}
    got = {(r.ba, r.ts_unix): r.anomaly_score for r in scores.collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9
    by_vectors = {(r.ba, r.ts_unix): r.anomaly_score for r in anomaly.reconstruction_error(model, vectors, settings).collect()}
    assert max(abs(got[k] - by_vectors[k]) for k in got) < 1e-9
    mean = anomaly.reconstruction_error(written, held_out, settings).agg(F.avg("anomaly_score")).first()[0]
    assert loss.first().loss == pytest.approx(mean, rel=1e-9)


def test_no_windows(complete):
    n, _, covariance = sliding.window_moments(complete.where("false"), S.SEQUENCE_SIGNALS, 3, F.lit(True))
    assert n == 0 and covariance.shape == (15, 15)
    assert sliding.projection_errors(complete.where("false"), S.SEQUENCE_SIGNALS, 2, np.zeros(10), np.eye(10)[:, :2]).count() == 0
    assert anomaly.train_anomaly(complete.withColumn("mismatch_label", F.lit(0)), replace(anomaly.AnomalySettings(), length=5000))[0] is None


def test_rows_travel_once(complete):
    """No array of a window's length leaves a task: the plan deals single rows, and writes no sequence out."""
    plan = sliding.projection_errors(complete, S.SEQUENCE_SIGNALS, 168, np.zeros(840), np.eye(840)[:, :2])._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "Window" not in plan
