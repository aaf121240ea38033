import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.operators.quantiles import approximate_quantiles, exact_quantiles, order_statistics
from hourloom.operators.reports import describe, histogram, score_range, score_thresholds

RNG = random.Random(3)
CASES = {
    "normal": [RNG.gauss(0, 1) for _ in range(1001)],
    "ties": [0.0] * 700 + [-1.5] * 200 + [RNG.random() for _ in range(101)],
    "wide": [RNG.choice((-1, 1)) * 10 ** RNG.uniform(-300, 300) for _ in range(500)],
    "close": [1.0 + i * 2**-52 for i in range(300)],
    "powers": [2.0**i for i in range(-20, 20)] + [-(2.0**i) for i in range(-20, 20)],
    "tiny": [5e-324, 0.0, -5e-324, 1e-310, -1e-310],
    "endless": [float("inf"), float("-inf"), 1.0, 2.0, 3.0],
    "one": [4.25],
}


@pytest.mark.parametrize("case", CASES)
def test_every_rank(spark, case):
    values = CASES[case]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    ranks = sorted({0, len(values) // 3, len(values) // 2, len(values) - 1})
    found = order_statistics(df, "v", F.array(*[F.lit(r).cast("bigint") for r in ranks]))
    assert {(r["rank"], r["v"]) for r in found.collect()} == {(r, sorted(values)[r]) for r in ranks}


def test_quantiles_by_group(spark):
    rows = [(g, float(v)) for g, case in (("x", "normal"), ("y", "ties")) for v in CASES[case]] + [("x", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {(r.g, r.probability): r.v for r in exact_quantiles(df, "v", [0.25, 0.99], ["g"]).collect()}
    for g, case in (("x", "normal"), ("y", "ties")):
        for p in (0.25, 0.99):
            assert found.pop((g, p)) == pytest.approx(np.quantile(CASES[case], p), abs=1e-12)
    assert not found


def test_approximate_quantile_is_near(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1001)], "v double")
    rows = approximate_quantiles(df, "v", [0.5, 0.99]).collect()
    assert [(r.probability, r.v) for r in rows] == [(0.5, 500.0), (0.99, 990.0)]


def test_no_rows(spark):
    df = spark.createDataFrame([], "ba string, anomaly_score double")
    assert exact_quantiles(df, "anomaly_score", [0.5]).count() == 0
    assert score_range(df).first().asDict() == {"low": None, "high": None, "threshold": None}
    assert score_thresholds(df).count() == 0
    assert histogram(df).count() == 0


def test_histogram_counts_every_value_once(spark):
    values = CASES["normal"] + [min(CASES["normal"])] * 5
    df = spark.createDataFrame([(v,) for v in values], "anomaly_score double")
    counts, edges = np.histogram(values, bins=20)
    rows = histogram(df, bins=20).orderBy("bin").collect()
    assert [r.rows for r in rows] == counts.tolist()
    assert [r.low for r in rows] == pytest.approx(edges[:-1].tolist())
    assert histogram(df.limit(1), bins=4).agg(F.sum("rows")).first()[0] == 1


def test_describe(spark):
    values = CASES["normal"]
    row = describe(spark.createDataFrame([(v,) for v in values], "v double"), "v").first()
    expected = (len(values), np.mean(values), np.std(values, ddof=1), min(values), *np.quantile(values, [0.25, 0.5, 0.75]), max(values))
    assert tuple(row) == pytest.approx(expected)
