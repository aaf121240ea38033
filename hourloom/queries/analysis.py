"""Queries of windows, reports, metrics and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators import metrics, reports, sketches
from hourloom.operators.cleaning import complete_cases
from hourloom.operators.neighbours import IN_BLOCK, over_series
from hourloom.operators.quantiles import approximate_quantiles, exact_quantiles
from hourloom.operators.windows import add_lags, add_leads, add_rolling, feature_table, hourly_grid, sequences
from hourloom.plans.anomaly import signal_scales, standardise
from hourloom.queries.grids import EVENT_SQL, SHIPMENT_SQL, STEP_SQL, event_grid, shipment_grid, step_grid
from hourloom.queries.registry import query, r4, r4_sql
from hourloom.session import durable, stored

# -- windows ---------------------------------------------------------------------------------
# Short blocks here, so that the checks cross many block borders.

_SERIES = "PARTITION BY ba ORDER BY ts_unix"


def _lag_sql(s: str, h: int) -> str:
    return f"lag({s}_mw, {h}) OVER ({_SERIES})"


def _lead_sql(s: str, h: int) -> str:
    return f"lead({s}_mw, {h}) OVER ({_SERIES})"


def _roll_sql(s: str, hours: int, function: str) -> str:
    return f"{function}({s}_mw) OVER ({_SERIES} RANGE BETWEEN {(hours - 1) * 3600} PRECEDING AND CURRENT ROW)"


def _total(columns: list[str]) -> F.Column:
    """Sum of many columns, nulls as 0, in one expression."""
    return F.aggregate(F.array(*columns), F.lit(0.0), lambda total, x: total + F.coalesce(x, F.lit(0.0)))


def _total_sql(columns: list[str]) -> str:
    return " + ".join(f"coalesce({c}, 0)" for c in columns)


_SOME_LAGS = [(s, h) for s in S.HISTORY_SIGNALS for h in (1, 2, 24, 48)]
_ALL_LAGS_SQL = [_lag_sql(s, h) for s in S.HISTORY_SIGNALS for h in S.LAG_HOURS]
_LAGS_SQL = ", ".join(f"{_lag_sql(s, h)} AS {S.lag_name(s, h)}" for s, h in _SOME_LAGS)


def _some_lags(lagged: DataFrame) -> DataFrame:
    return lagged.select(
        "ba", "ts_unix", *[S.lag_name(s, h) for s, h in _SOME_LAGS], r4(_total(S.LAG_COLUMNS)).alias("all_lags")
    )


def _steps(spark: SparkSession, sf_dir: str, signals: tuple[str, ...] = S.HISTORY_SIGNALS) -> DataFrame:
    """The step grid with these signals only: windows keep every column of a panel alive, also those nobody reads later."""
    return step_grid(spark, sf_dir).select("ba", "ts_unix", *[f"{s}_mw" for s in signals])


@query(STEP_SQL + f" SELECT ba, ts_unix, {_LAGS_SQL}, {r4_sql(_total_sql(_ALL_LAGS_SQL))} AS all_lags FROM panel")
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _some_lags(add_lags(stored(_steps(spark, sf_dir), "steps"), block_days=20))


def _lag_at_sql(s: str, h: int) -> str:
    return f"max({s}_mw) OVER ({_SERIES} RANGE BETWEEN {h * 3600} PRECEDING AND {h * 3600} PRECEDING)"


_LAGS_AT_SQL = ", ".join(f"{_lag_at_sql(s, h)} AS {S.lag_name(s, h)}" for s, h in _SOME_LAGS)
_ALL_LAGS_AT_SQL = _total_sql([_lag_at_sql(s, h) for s in S.HISTORY_SIGNALS for h in S.LAG_HOURS])


@query(STEP_SQL + f" SELECT ba, ts_unix, {_LAGS_AT_SQL}, {r4_sql(_ALL_LAGS_AT_SQL)} AS all_lags FROM panel")
def lag_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _some_lags(add_lags(_steps(spark, sf_dir), mode="time", block_days=20))


def _rolled(statistic: str) -> list[str]:
    return [S.rolling_name(s, w, statistic) for w in S.ROLLING_HOURS for s in S.HISTORY_SIGNALS]


def _rolled_sql(statistic: str, function: str) -> str:
    return ", ".join(
        f"{r4_sql(_roll_sql(s, hours, function))} AS {S.rolling_name(s, w, statistic)}"
        for w, hours in S.ROLLING_HOURS.items()
        for s in S.HISTORY_SIGNALS
    )


@query(STEP_SQL + f" SELECT ba, ts_unix, {_rolled_sql('mean', 'avg')} FROM panel")
def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_rolling(_steps(spark, sf_dir), statistics=["mean"]).select("ba", "ts_unix", *[r4(c).alias(c) for c in _rolled("mean")])


@query(STEP_SQL + f" SELECT ba, ts_unix, {_rolled_sql('std', 'stddev_pop')} FROM panel")
def rolling_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_rolling(_steps(spark, sf_dir), statistics=["std"]).select("ba", "ts_unix", *[r4(c).alias(c) for c in _rolled("std")])


@query(EVENT_SQL + f" SELECT ba, ts_unix, {_rolled_sql('mean', 'avg')}, {_rolled_sql('std', 'stddev_pop')} FROM panel")
def halo_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of two days under a frame of seven."""
    rolled = add_rolling(event_grid(spark, sf_dir), block_days=2)
    return rolled.select("ba", "ts_unix", *[r4(c).alias(c) for c in _rolled("mean") + _rolled("std")])


_LEADS_SQL = ", ".join(f"{_lead_sql(s, h)} AS {S.lead_name(s, h)}" for h in S.LEAD_HOURS for s in S.LEAD_SIGNALS)


@query(STEP_SQL + f" SELECT ba, ts_unix, {_LEADS_SQL} FROM panel")
def lead_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_leads(stored(_steps(spark, sf_dir, S.LEAD_SIGNALS), "steps"), block_days=20).select("ba", "ts_unix", *S.LEAD_COLUMNS)


_ALL_ROLLS_SQL = [
    _roll_sql(s, hours, f) for s in S.HISTORY_SIGNALS for hours in S.ROLLING_HOURS.values() for f in ("avg", "stddev_pop")
]


@query(
    EVENT_SQL
    + f""" SELECT ba, ts_unix, {_LAGS_SQL}, {r4_sql(_total_sql(_ALL_LAGS_SQL))} AS all_lags,
 {r4_sql(_total_sql(_ALL_ROLLS_SQL))} AS all_rolling, {_LEADS_SQL},
 {r4_sql('mismatch_mw')} AS mismatch_mw, {r4_sql('mismatch_pct')} AS mismatch_pct, CAST(mismatch_label AS INT) AS mismatch_label
FROM panel"""
)
def feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full feature table: a part of its columns, and sums over all the others."""
    panel = event_grid(spark, sf_dir).drop(*S.MISMATCH_COLUMNS)
    features = feature_table(panel, block_days=10)
    return features.select(
        "ba",
        "ts_unix",
        *[S.lag_name(s, h) for s, h in _SOME_LAGS],
        r4(_total(S.LAG_COLUMNS)).alias("all_lags"),
        r4(_total(S.ROLLING_COLUMNS)).alias("all_rolling"),
        *S.LEAD_COLUMNS,
        r4("mismatch_mw").alias("mismatch_mw"),
        r4("mismatch_pct").alias("mismatch_pct"),
        "mismatch_label",
    )


@query(
    EVENT_SQL
    + """, spans AS (SELECT ba, min(ts_unix) AS a, max(ts_unix) AS b FROM panel GROUP BY ba),
hours AS (SELECT ba, unnest(range(a, b + 1, 3600)) AS ts_unix FROM spans)
SELECT h.ba, h.ts_unix, p.demand_mw, p.solar_mw FROM hours h LEFT JOIN panel p ON h.ba = p.ba AND h.ts_unix = p.ts_unix"""
)
def gap_filled_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_grid(event_grid(spark, sf_dir).select("ba", "ts_unix", "demand_mw", "solar_mw"))


_RECENT = f"({_SERIES} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)"
_STEP_SUM = " + ".join(S.SEQUENCE_SIGNALS)


@query(
    EVENT_SQL
    + f""", complete AS (SELECT * FROM panel WHERE demand_mw IS NOT NULL),
built AS (SELECT ba, ts_unix, count(*) OVER {_RECENT} AS steps, first_value(solar_mw) OVER {_RECENT} AS first,
                 interchange_mw AS last, sum({_STEP_SUM}) OVER {_RECENT} AS total FROM complete)
SELECT ba, ts_unix, CAST(840 AS INT) AS size, first, last, {r4_sql('total')} AS total FROM built WHERE steps = 168"""
)
def sequence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = complete_cases(event_grid(spark, sf_dir), ["demand_mw"])
    built = sequences(panel, block_days=5)
    return built.select(
        "ba",
        "ts_unix",
        F.size("sequence").alias("size"),
        F.col("sequence")[0].alias("first"),
        F.element_at("sequence", -1).alias("last"),
        r4(F.aggregate("sequence", F.lit(0.0), lambda total, x: total + x)).alias("total"),
    )


# -- reports ---------------------------------------------------------------------------------


@query(SHIPMENT_SQL + " SELECT count(*) AS rows FROM panel")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.row_count(shipment_grid(spark, sf_dir))


@query(SHIPMENT_SQL + " SELECT year, count(*) AS rows FROM panel GROUP BY year")
def rows_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rows_per_year(shipment_grid(spark, sf_dir))


@query(SHIPMENT_SQL + " SELECT count(DISTINCT ba) AS entities FROM panel")
def entity_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.entity_count(shipment_grid(spark, sf_dir))


@query(SHIPMENT_SQL + " SELECT DISTINCT ba FROM panel WHERE ba IS NOT NULL ORDER BY ba")
def entity_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.entity_list(shipment_grid(spark, sf_dir))


@query(
    EVENT_SQL
    + f""", counted AS (SELECT mismatch_label, count(*) AS rows FROM panel GROUP BY 1)
SELECT CAST(mismatch_label AS INT) AS mismatch_label, rows, {r4_sql('rows * 100.0 / (SELECT count(*) FROM panel)')} AS percent
FROM counted WHERE mismatch_label IS NOT NULL"""
)
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.class_distribution(event_grid(spark, sf_dir)).withColumn("percent", r4("percent"))


@query(
    EVENT_SQL
    + """ SELECT CASE mismatch_label WHEN 0 THEN 'Balanced' WHEN 1 THEN 'Mod Surplus' WHEN 2 THEN 'Sev Surplus' ELSE 'Deficit' END AS severity_class,
 count(*) AS rows FROM panel WHERE mismatch_label IS NOT NULL GROUP BY 1 ORDER BY 1"""
)
def class_counts_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.class_counts_named(event_grid(spark, sf_dir))


_SHARES_SQL = ", ".join(
    f"{r4_sql(f'avg(CASE WHEN mismatch_label = {k} THEN 1.0 ELSE 0.0 END)')} AS share_{k}" for k in S.CLASS_NAMES
)
_HEATMAP_SQL = f"SELECT hour_of_day, month, count(*) AS rows, {_SHARES_SQL} FROM panel WHERE mismatch_label IS NOT NULL GROUP BY 1, 2"


@query(SHIPMENT_SQL + " " + _HEATMAP_SQL)
def mismatch_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    heat = reports.mismatch_heatmap(shipment_grid(spark, sf_dir))
    return heat.select("hour_of_day", "month", "rows", *[r4(f"share_{k}").alias(f"share_{k}") for k in S.CLASS_NAMES])


@query(
    SHIPMENT_SQL
    + f", heat AS ({_HEATMAP_SQL}) SELECT hour_of_day, "
    + ", ".join(f"max(share_3) FILTER (WHERE month = {i + 1}) AS {m}" for i, m in enumerate(reports.MONTHS))
    + " FROM heat GROUP BY 1"
)
def heatmap_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.heatmap_pivot(mismatch_heatmap(spark, sf_dir), 3)


_DEFICIT_SQL = r4_sql("avg(CASE WHEN mismatch_label = 3 THEN 1.0 ELSE 0.0 END) * 100")


@query(
    EVENT_SQL
    + f""" SELECT count(*) AS rows, {r4_sql('avg(solar_mw)')} AS avg_solar_mw, {r4_sql('avg(wind_mw)')} AS avg_wind_mw,
 {r4_sql('avg(demand_mw)')} AS avg_demand_mw, {_DEFICIT_SQL} AS deficit_pct FROM panel"""
)
def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.summary(event_grid(spark, sf_dir))
    return found.select("rows", *[r4(c).alias(c) for c in found.columns if c != "rows"])


@query(EVENT_SQL + f" SELECT ba, {_DEFICIT_SQL} AS deficit_pct FROM panel GROUP BY ba")
def deficit_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.deficit_share(event_grid(spark, sf_dir), ["ba"]).withColumn("deficit_pct", r4("deficit_pct"))


# -- metrics ---------------------------------------------------------------------------------


def _persistence_sql() -> str:
    parts = []
    for s in S.LEAD_SIGNALS:
        for h in S.LEAD_HOURS:
            parts.append(f"SELECT '{s}' AS source, '{h}h' AS horizon, {_lead_sql(s, h)} AS y, {s}_mw AS p FROM panel")
    return (
        ", pairs AS (" + " UNION ALL ".join(parts) + "), kept AS (SELECT * FROM pairs WHERE y IS NOT NULL AND p IS NOT NULL), "
        "means AS (SELECT source, horizon, avg(y) AS m FROM kept GROUP BY 1, 2), "
        f"measured AS (SELECT source, horizon, count(*) AS n, {r4_sql('avg(abs(y - p))')} AS mae, {r4_sql('sqrt(avg((y - p) * (y - p)))')} AS rmse, "
        f"{r4_sql('1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m))')} AS r2 FROM kept JOIN means USING (source, horizon) GROUP BY 1, 2)"
    )


@query(EVENT_SQL + _persistence_sql() + " SELECT source, horizon, n, mae, rmse, r2 FROM measured")
def persistence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = metrics.persistence_metrics(add_leads(event_grid(spark, sf_dir)))
    return measured.select("source", "horizon", "n", *[r4(m).alias(m) for m in ("mae", "rmse", "r2")])


@query(
    EVENT_SQL
    + _persistence_sql()
    + """ SELECT horizon, max(mae) FILTER (WHERE source = 'solar') AS solar, max(mae) FILTER (WHERE source = 'wind') AS wind
FROM measured GROUP BY horizon"""
)
def metrics_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metrics_pivot(persistence_metrics(spark, sf_dir), "mae")


def _yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of 24 rows before as the prediction."""
    labelled = event_grid(spark, sf_dir).select("ba", "ts_unix", "mismatch_label")
    guess = f"lag(mismatch_label, 24) OVER ({IN_BLOCK}) AS predicted"
    return over_series(labelled, [guess], back_rows=24).dropna(subset=["mismatch_label", "predicted"])


_YESTERDAY_SQL = f""", guessed AS (
  SELECT mismatch_label AS y, lag(mismatch_label, 24) OVER ({_SERIES}) AS p FROM panel),
pairs AS (SELECT y, p FROM guessed WHERE y IS NOT NULL AND p IS NOT NULL),
classes AS (SELECT unnest([0, 1, 2, 3]) AS k),
counted AS (SELECT k, count_if(y = k AND p = k) AS hits, count_if(p = k) AS said, count_if(y = k) AS support
            FROM classes, pairs GROUP BY k),
rates AS (SELECT k, hits, support, CASE WHEN said > 0 THEN hits / said ELSE 0 END AS pr,
                 CASE WHEN support > 0 THEN hits / support ELSE 0 END AS re FROM counted),
scored AS (SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f FROM rates)"""


@query(
    EVENT_SQL
    + _YESTERDAY_SQL
    + f""" SELECT CASE k WHEN 0 THEN 'balanced' WHEN 1 THEN 'mod_surplus' WHEN 2 THEN 'sev_surplus' ELSE 'deficit' END AS class,
 {r4_sql('pr')} AS precision, {r4_sql('re')} AS recall, {r4_sql('f')} AS f1, CAST(support AS BIGINT) AS support FROM scored
UNION ALL SELECT 'accuracy', {r4_sql('sum(hits) / sum(support)')}, {r4_sql('sum(hits) / sum(support)')}, {r4_sql('sum(hits) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM scored
UNION ALL SELECT 'macro avg', {r4_sql('avg(pr)')}, {r4_sql('avg(re)')}, {r4_sql('avg(f)')}, CAST(sum(support) AS BIGINT) FROM scored
UNION ALL SELECT 'weighted avg', {r4_sql('sum(pr * support) / sum(support)')}, {r4_sql('sum(re * support) / sum(support)')}, {r4_sql('sum(f * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM scored"""
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.classification_report(_yesterday(spark, sf_dir), "mismatch_label", "predicted")
    return report.select("class", *[r4(m).alias(m) for m in ("precision", "recall", "f1")], "support")


@query(
    EVENT_SQL
    + _YESTERDAY_SQL
    + f""", others AS (SELECT k AS q FROM classes)
SELECT CAST(k AS INT) AS actual, CAST(q AS INT) AS predicted, count_if(y = k AND p = q) AS rows,
       {r4_sql('CASE WHEN count_if(y = k) > 0 THEN count_if(y = k AND p = q) / count_if(y = k) ELSE 0 END')} AS share
FROM classes, others, pairs GROUP BY k, q"""
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(_yesterday(spark, sf_dir), "mismatch_label", "predicted").withColumn("share", r4("share"))


# -- scores ----------------------------------------------------------------------------------
# The distance of demand from its normal mean, in deviations, stands in for a model's score.


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = event_grid(spark, sf_dir)
    scaled = standardise(panel, signal_scales(reports.normal_hours(panel), ["demand_mw"]), ["demand_mw"])
    score = F.round(F.abs("demand_mw"), 6).alias("anomaly_score")
    return scaled.where(F.col("demand_mw").isNotNull()).select("ba", "ts", "ts_unix", score)


def _stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores as a stored table, the way reports find them: exact quantiles read them several times."""
    return durable(_scores(spark, sf_dir))


_SCORES_SQL = """, norm AS (SELECT avg(demand_mw) AS m, stddev_pop(demand_mw) AS d FROM panel WHERE mismatch_label = 0),
scores AS (SELECT ba, ts, ts_unix, round(abs((demand_mw - m) / d), 6) AS anomaly_score FROM panel, norm WHERE demand_mw IS NOT NULL)"""


@query(
    EVENT_SQL
    + _SCORES_SQL
    + f""" SELECT {r4_sql('min(anomaly_score)')} AS low, {r4_sql('max(anomaly_score)')} AS high,
 {r4_sql('quantile_cont(anomaly_score, 0.99)')} AS threshold FROM scores"""
)
def score_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.score_range(_stored_scores(spark, sf_dir))
    return found.select(*[r4(c).alias(c) for c in found.columns])


@query(EVENT_SQL + _SCORES_SQL + f" SELECT ba, {r4_sql('quantile_cont(anomaly_score, 0.99)')} AS threshold FROM scores GROUP BY ba")
def score_threshold_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.score_thresholds(_stored_scores(spark, sf_dir)).select("ba", r4("threshold").alias("threshold"))


_PROBABILITIES = (0.0, 0.1, 0.5, 0.9, 1.0)


@query(
    SHIPMENT_SQL
    + " UNION ALL ".join(
        f" SELECT CAST({p} AS DOUBLE) AS probability, {r4_sql(f'quantile_cont(mismatch_mw, {p})')} AS mismatch_mw FROM panel"
        for p in _PROBABILITIES
    )
)
def mismatch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of both signs with very many equal ones."""
    found = exact_quantiles(durable(shipment_grid(spark, sf_dir).select("mismatch_mw")), "mismatch_mw", _PROBABILITIES)
    return found.select("probability", r4("mismatch_mw").alias("mismatch_mw"))


@query(EVENT_SQL + _SCORES_SQL + " SELECT CAST(0.99 AS DOUBLE) AS probability, count(*) AS n, true AS within_bound FROM scores")
def approximate_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the ranks of the value found reach the wanted rank but for ``n / accuracy``."""
    scores, accuracy = _stored_scores(spark, sf_dir), 10_000
    found = approximate_quantiles(scores, "anomaly_score", [0.99], accuracy)
    value, score = found.select("anomaly_score").scalar(), F.col("anomaly_score")
    wanted, error = F.col("n") * 0.99, F.ceil(F.col("n") / accuracy)
    ranks = scores.agg(F.count("*").alias("n"), F.count_if(score < value).alias("below"), F.count_if(score <= value).alias("upto"))
    within = (F.col("below") <= wanted + error) & (F.col("upto") >= wanted - error)
    return ranks.select(F.lit(0.99).alias("probability"), "n", within.alias("within_bound"))


@query(
    SHIPMENT_SQL
    + """, scored AS (SELECT ba, year, abs(net_gen_mw) AS score FROM panel WHERE net_gen_mw IS NOT NULL)
SELECT ba, count(*) AS n, min(score) AS low, max(score) AS high, true AS within_bound FROM scored GROUP BY ba
UNION ALL SELECT 'last years', count(*), min(score), max(score), true FROM scored WHERE year >= (SELECT max(year) - 1 FROM scored)"""
)
def sketched_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds of every series, and of all series in the last two years, from merged sketches by series and year: numbers, least and
    greatest are exact, and the threshold's rank lies within the stated bound."""
    scores = durable(shipment_grid(spark, sf_dir).select("ba", "ts_unix", "year", F.abs("net_gen_mw").alias("anomaly_score")))
    stored = durable(sketches.score_sketches(scores))
    last = F.col("year") >= scores.agg(F.max("year") - 1).scalar()
    whole = sketches.sketched_range(stored.where(last)).select(F.lit("last years").alias("ba"), "*")
    every = sketches.sketched_range(stored, by=["ba"]).unionByName(whole)
    groups = scores.select("ba", "anomaly_score").unionByName(scores.where(last).select(F.lit("last years").alias("ba"), "anomaly_score"))
    ranks = groups.join(every, "ba").groupBy("ba", "n", "low", "high").agg(
        F.count_if(F.col("anomaly_score") < F.col("threshold")).alias("below"), F.count_if(F.col("anomaly_score") <= F.col("threshold")).alias("upto")
    )
    room = sketches.rank_error() * F.col("n") + 1
    within = (F.col("below") <= 0.99 * F.col("n") + room) & (F.col("upto") >= 0.99 * F.col("n") - room)
    return ranks.select("ba", "n", "low", "high", within.alias("within_bound"))


@query(
    EVENT_SQL
    + _SCORES_SQL
    + f""", edges AS (SELECT min(anomaly_score) AS a, max(anomaly_score) AS b FROM scores),
binned AS (SELECT least(CAST(floor((anomaly_score - a) / ((b - a) / 100)) AS INT), 99) AS bin, count(*) AS n FROM scores, edges GROUP BY 1),
bins AS (SELECT CAST(unnest(range(100)) AS INT) AS bin)
SELECT bin, {r4_sql('a + bin * ((b - a) / 100)')} AS low, {r4_sql('a + (bin + 1) * ((b - a) / 100)')} AS high, coalesce(n, 0) AS rows
FROM bins LEFT JOIN binned USING (bin), edges"""
)
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.histogram(_stored_scores(spark, sf_dir))
    return found.select("bin", r4("low").alias("low"), r4("high").alias("high"), "rows")


@query(
    EVENT_SQL
    + _SCORES_SQL
    + f""" SELECT count(*) AS count, {r4_sql('avg(anomaly_score)')} AS mean, {r4_sql('stddev_samp(anomaly_score)')} AS std,
 {r4_sql('min(anomaly_score)')} AS min, {r4_sql('quantile_cont(anomaly_score, 0.25)')} AS q25, {r4_sql('quantile_cont(anomaly_score, 0.5)')} AS q50,
 {r4_sql('quantile_cont(anomaly_score, 0.75)')} AS q75, {r4_sql('max(anomaly_score)')} AS max FROM scores"""
)
def score_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.describe(_stored_scores(spark, sf_dir), "anomaly_score")
    return found.select("count", *[r4(c).alias(c) for c in found.columns if c != "count"])


@query(
    EVENT_SQL
    + _SCORES_SQL
    + f""" SELECT ba, count(*) AS rows, count_if(anomaly_score > t) AS flagged, {r4_sql('count_if(anomaly_score > t) / count(*)')} AS share
FROM scores, (SELECT quantile_cont(anomaly_score, 0.99) AS t FROM scores) GROUP BY ba"""
)
def anomaly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _stored_scores(spark, sf_dir)
    threshold = exact_quantiles(scores, "anomaly_score", [0.99]).select("anomaly_score").scalar()
    return reports.anomaly_flags(scores, threshold).withColumn("share", r4("share"))


@query(
    EVENT_SQL
    + _SCORES_SQL
    + f""" SELECT ts_unix, {r4_sql('anomaly_score')} AS anomaly_score FROM scores
WHERE ba = 'purchase' AND ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' ORDER BY ts_unix"""
)
def anomaly_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.timeline(_scores(spark, sf_dir), "purchase", "2024-01-10", "2024-01-20")
    return rows.select("ts_unix", r4("anomaly_score").alias("anomaly_score"))
