"""Queries of the model plans, at the library's defaults; only the softmax classifier runs fewer rounds than its default.

Numbers that depend on the fit are checked by their bounds; an arithmetic score decides the splits, so that SQL knows
the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators.metrics import classification_report
from hourloom.operators.reports import score_range
from hourloom.operators.windows import feature_table
from hourloom.plans.anomaly import AnomalySettings, train_anomaly
from hourloom.plans.forecast import TARGETS, ForecastSettings, compare_on_sample, train_forecasters
from hourloom.plans.severity import SeveritySettings, importances, top_importances, train_severity
from hourloom.queries.grids import EVENT_SQL, FRACTION, SCORE, event_grid, event_sql
from hourloom.queries.registry import query
from hourloom.session import stored

_FORECAST = ForecastSettings(score=FRACTION)
_SEVERITY = SeveritySettings(kind="forest", score=SCORE)
_SOFTMAX = SeveritySettings(trees=30, patience=5, step=0.3, score=SCORE)
_ANOMALY = AnomalySettings(score=FRACTION)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With demand in every hour: one missing value would empty the 48 rows after it."""
    return stored(feature_table(event_grid(spark, sf_dir, least_rows=1)), "features")


#: Rows by their place in the series: the first 48 have no complete inputs, the last ones no target.
_PLACED_SQL = (
    event_sql(1)
    + """, placed AS (
  SELECT *, row_number() OVER (PARTITION BY ba ORDER BY ts_unix) AS place, count(*) OVER (PARTITION BY ba) AS places,
         lead(solar_mw, 24) OVER (PARTITION BY ba ORDER BY ts_unix) AS solar_ahead FROM panel)"""
)


@query(
    _PLACED_SQL
    + " UNION ALL ".join(
        f""" SELECT '{source}' AS source, '{h}h' AS horizon, count_if({FRACTION} < 0.15) AS n, true AS mae_fits, true AS rmse_fits, true AS r2_fits
FROM placed WHERE place > 48 AND place <= places - {h} HAVING count_if({FRACTION} >= 0.15) > 0"""
        for source, h in TARGETS
    )
)
def forecast_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = train_forecasters(_features(spark, sf_dir), settings=_FORECAST)[1]
    fits = {"mae": F.col("mae") >= 0, "rmse": F.col("rmse") >= F.col("mae") - 1e-9, "r2": F.col("r2") <= 1}
    return found.select("source", "horizon", "n", *[fit.alias(f"{name}_fits") for name, fit in fits.items()])


@query(
    _PLACED_SQL
    + f""" SELECT ba, ts_unix, solar_ahead AS actual, true AS predicted FROM placed
WHERE place > 48 AND solar_ahead IS NOT NULL ORDER BY {SCORE}, ba, ts_unix LIMIT 10000"""
)
def forecast_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _features(spark, sf_dir)
    models, _ = train_forecasters(features, [("solar", 24)], _FORECAST)
    target = "solar_t24h_ahead"
    if not models:
        return features.selectExpr("ba", "ts_unix", f"{target} AS actual", "true AS predicted").limit(0)
    sample = compare_on_sample(models["solar", 24], features, target, score=F.expr(SCORE))
    return sample.select("ba", "ts_unix", "actual", F.col("prediction").isNotNull().alias("predicted"))


_COMPLETE_SQL = (
    _PLACED_SQL
    + f""", complete AS (
  SELECT mismatch_label AS y, rank() OVER (PARTITION BY mismatch_label ORDER BY {SCORE})
           <= floor(count(*) OVER (PARTITION BY mismatch_label) * 0.15 + 0.5) AS held
  FROM placed WHERE place > 48 AND mismatch_pct IS NOT NULL)"""
)


_REPORT_SQL = (
    _COMPLETE_SQL
    + f""", counts AS (
  SELECT name, count(y) AS support
  FROM (VALUES {", ".join(f"({k}, '{name}')" for k, name in S.REPORT_CLASS_NAMES.items())}) AS c(k, name)
  LEFT JOIN complete ON y = k AND held GROUP BY name)
SELECT name AS class, support, true AS bounded FROM counts
UNION ALL SELECT name, CAST((SELECT sum(support) FROM counts) AS BIGINT), true
FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) AS s(name)"""
)


def _report(spark: SparkSession, sf_dir: str, settings: SeveritySettings) -> DataFrame:
    predictions = train_severity(_features(spark, sf_dir), settings)[2]
    report = classification_report(predictions, "actual", "predicted")
    bounded = F.forall(F.array("precision", "recall", "f1"), lambda m: (m >= 0) & (m <= 1))
    return report.select("class", "support", bounded.alias("bounded"))


@query(_REPORT_SQL)
def severity_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, _SEVERITY)


@query(_REPORT_SQL)
def severity_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, _SOFTMAX)


@query(
    _COMPLETE_SQL
    + """ SELECT CAST(unnest(range(1, 21)) AS INT) AS position, 173 AS inputs, true AS sums_to_one, true AS ordered
WHERE EXISTS (SELECT * FROM complete WHERE NOT held)"""
)
def severity_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top 20 by position: how many inputs there are, whether all sum to 1, whether the order falls."""
    model, inputs, _ = train_severity(_features(spark, sf_dir), _SEVERITY)
    if model is None:
        return spark.createDataFrame([], "position int, inputs int, sums_to_one boolean, ordered boolean")
    total = importances(spark, model, inputs).agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("whole")).select("whole").scalar()
    by_weight = Window.orderBy(F.desc("importance"), "name")  # twenty rows
    falls = F.coalesce(F.col("importance") <= F.lag("importance").over(by_weight), F.lit(True))
    return top_importances(spark, model, inputs).select(
        F.row_number().over(by_weight).alias("position"), F.lit(len(inputs)).alias("inputs"), total.alias("sums_to_one"), falls.alias("ordered")
    )


_SEQUENCES_SQL = (
    EVENT_SQL
    + f""", complete AS (
  SELECT ba, ts_unix, mismatch_label, row_number() OVER (PARTITION BY ba ORDER BY ts_unix) AS place FROM panel WHERE demand_mw IS NOT NULL),
normal AS (SELECT ba, ts_unix, row_number() OVER (PARTITION BY ba ORDER BY ts_unix) AS place FROM complete WHERE mismatch_label = 0),
fitted AS (SELECT count(*) >= 2 AS enough FROM normal WHERE place >= 168 AND {FRACTION} >= 0.1)"""
)


@query(_SEQUENCES_SQL + " SELECT ba, ts_unix, true AS valid FROM complete WHERE place >= 168 AND (SELECT enough FROM fitted)")
def sequence_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = train_anomaly(stored(event_grid(spark, sf_dir), "panel"), _ANOMALY)[2]
    return scores.select("ba", "ts_unix", (F.col("anomaly_score") >= 0).alias("valid"))


@query(_SEQUENCES_SQL + " SELECT CASE WHEN enough THEN true END AS valid, CASE WHEN enough THEN true END AS ordered FROM fitted")
def sequence_anomaly_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = train_anomaly(stored(event_grid(spark, sf_dir), "panel"), _ANOMALY)[2]
    found = score_range(stored(scores, "scores"))
    ordered = (F.col("low") <= F.col("threshold")) & (F.col("threshold") <= F.col("high"))
    return found.select((F.col("low") >= 0).alias("valid"), ordered.alias("ordered"))
