"""Queries of sources, cleaning, filters, labels and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.functions.scalar import calendar_columns, label_name
from hourloom.operators import cleaning, labels, reports, sampling
from hourloom.operators.alignment import actual_vs_forecast, attach_scores, event_overlay
from hourloom.operators.windows import add_leads
from hourloom.plans.anomaly import signal_scales, standardise
from hourloom.queries.grids import EVENT_SQL, FRACTION, SCORE, SHIPMENT_SQL, event_grid, shipment_grid, table
from hourloom.queries.registry import query, r4, r4_sql
from hourloom.session import durable
from hourloom.sources import raw
from hourloom.sources.tables import load

# -- sources ---------------------------------------------------------------------------------


def _ship_years(lines: DataFrame) -> DataFrame:
    year = F.year("l_shipdate")
    return lines.agg(F.min(year).alias("first"), F.max(year).alias("last"))


_MANIFEST_SQL = """
WITH span AS (SELECT min(year(l_shipdate)) AS a, max(year(l_shipdate)) AS b FROM lineitem),
years AS (SELECT unnest(range(a, b + 1)) AS y FROM span),
expected AS (SELECT CAST(y AS INT) AS year, half, 'EIA930_BALANCE_' || y || '_' || half || '.csv' AS file_name
             FROM years, (VALUES ('Jan_Jun'), ('Jul_Dec')) AS h(half))"""


@query(_MANIFEST_SQL + " SELECT year, half, file_name FROM expected")
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.expected_files(_ship_years(table(spark, sf_dir, "lineitem")))


@query(
    _MANIFEST_SQL
    + """, present AS (
  SELECT 'EIA930_BALANCE_' || year(l_shipdate) || '_' || CASE WHEN month(l_shipdate) <= 6 THEN 'Jan_Jun' ELSE 'Jul_Dec' END || '.csv' AS file_name,
         CAST(sum(length(CAST(l_orderkey AS VARCHAR)) + 16) AS BIGINT) AS bytes
  FROM lineitem GROUP BY 1)
SELECT year, half, file_name, bytes,
       CASE WHEN bytes IS NULL THEN 'missing' WHEN bytes < 65536 THEN 'tiny' ELSE 'ok' END AS status
FROM expected LEFT JOIN present USING (file_name)"""
)
def coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-yearly drops of ``lineitem`` as they would lie in a directory."""
    lines = table(spark, sf_dir, "lineitem")
    present = lines.groupBy(raw.file_name(F.year("l_shipdate"), raw.half_of(F.col("l_shipdate"))).alias("file_name")).agg(
        F.sum(F.length(F.col("l_orderkey").cast("string")) + 16).alias("bytes")
    )
    return raw.audit_files(raw.expected_files(_ship_years(lines)), present, min_bytes=65_536)


@query(
    """SELECT event_id, user_id, CAST(NULL AS DOUBLE) AS value FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, CAST(NULL AS BIGINT), value FROM events WHERE event_type <> 'click'"""
)
def union_mixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id")
    return raw.union_frames([clicks, events.where("event_type <> 'click'").select("value", "event_id")])


@query("SELECT event_type, value FROM events")
def projected_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, f"{sf_dir}/events.parquet", ["event_type", "not_there", "value", "event_type"])


_LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
    "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


@query(
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS pos, '{name}' AS name, '{kind}' AS type, count({name}) AS filled FROM lineitem"
        for i, (name, kind) in enumerate(_LINE_TYPES.items())
    )
)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.schema_report(table(spark, sf_dir, "lineitem"))


@query(
    """SELECT DISTINCT ba FROM (SELECT event_type AS ba FROM events
UNION ALL SELECT l_returnflag || l_linestatus FROM lineitem) WHERE ba IS NOT NULL"""
)
def distinct_entities_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("ba"))
    lines = table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("ba"))
    return raw.distinct_entities([events, lines])


# -- cleaning --------------------------------------------------------------------------------


def _raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a raw file would hold them: published headers, text, blanks and bad values."""
    events = table(spark, sf_dir, "events")
    stamp = F.date_format(F.date_trunc("hour", F.col("ts").cast("timestamp")), "MM/dd/yyyy h:mm:ss a")
    amount = F.format_string("%,.2f", F.col("value") * 1000)
    user = F.col("user_id")
    return events.select(
        F.when(user % 17 == 0, "no time").when(user % 19 != 0, stamp).alias(" utc time at end of hour "),
        F.when(user % 13 != 0, F.col("event_type")).alias("Balancing Authority"),
        F.when(user % 11 != 0, amount).otherwise("n/a").alias("Demand (MW) (Adjusted)"),
        amount.alias("Demand (MW)"),
        F.when(user % 5 != 0, amount).otherwise("").alias("Net Generation (MW) from Solar (Adjusted)"),
        amount.alias("Net Generation (MW) from Solar (Imputed)"),
        F.format_string("%d.csv", user % 7).alias("source_file"),
    )


_RAW_SQL = """
WITH raw AS (
  SELECT CASE WHEN user_id % 17 = 0 OR user_id % 19 = 0 THEN NULL ELSE date_trunc('hour', ts) END AS ts,
         CASE WHEN user_id % 13 <> 0 THEN event_type END AS ba,
         CASE WHEN user_id % 11 <> 0 THEN round(value * 1000, 2) END AS demand_mw,
         CASE WHEN user_id % 5 <> 0 THEN round(value * 1000, 2) END AS solar_mw,
         user_id % 7 || '.csv' AS source_file FROM events)"""


@query(
    _RAW_SQL
    + """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ba, ts ORDER BY source_file DESC, demand_mw DESC NULLS LAST, solar_mw DESC NULLS LAST) AS rn
  FROM raw WHERE ts IS NOT NULL AND ba IS NOT NULL)
SELECT ba, strftime(ts, '%m/%d/%Y %-I:%M:%S %p') AS ts_utc, CAST(epoch(ts) AS BIGINT) AS ts_unix,
       CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(dayofweek(ts) + 1 AS INT) AS day_of_week,
       CAST(hour(ts) AS INT) AS hour_of_day, CAST(weekofyear(ts) AS INT) AS week_of_year,
       demand_mw, CAST(NULL AS DOUBLE) AS unknown_mw, coalesce(solar_mw, 0) AS solar_mw, CAST(0 AS DOUBLE) AS wind_mw
FROM ranked WHERE rn = 1"""
)
def clean_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = cleaning.clean_panel(cleaning.normalise_columns(_raw_text(spark, sf_dir)))
    return panel.select("ba", "ts_utc", "ts_unix", *S.CALENDAR, "demand_mw", "unknown_mw", "solar_mw", "wind_mw")


@query(
    """SELECT 'ts_utc' AS "column", count_if(user_id % 17 = 0 OR user_id % 19 <> 0) AS filled, count_if(user_id % 17 = 0) AS rejected FROM events
UNION ALL SELECT 'demand_mw', count(*), count_if(user_id % 11 = 0) FROM events
UNION ALL SELECT 'solar_mw', count_if(user_id % 5 <> 0), 0 FROM events"""
)
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = cleaning.normalise_columns(_raw_text(spark, sf_dir))
    return cleaning.reject_counts(text.select("ts_utc", "demand_mw", "solar_mw"))


@query(
    """SELECT l_suppkey, l_shipdate, l_orderkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate
                               ORDER BY l_orderkey DESC, l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1"""
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_quantity", "l_extendedprice")
    return cleaning.dedup_latest(lines, ["l_suppkey", "l_shipdate"], first_by="l_orderkey")


@query(SHIPMENT_SQL + " SELECT ba, ts_unix, year, month, day_of_week, hour_of_day, week_of_year FROM panel")
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar parts recomputed from the epoch seconds."""
    seconds = shipment_grid(spark, sf_dir).select("ba", "ts_unix").withColumn("ts", F.timestamp_seconds("ts_unix"))
    return seconds.select("ba", "ts_unix", *calendar_columns(F.col("ts")))


def _holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN user_id % 8 = 0 THEN value END AS solar_mw",
        "CASE WHEN user_id % 7 = 0 THEN double('Infinity') WHEN user_id % 7 = 1 THEN double('-Infinity') ELSE value END AS demand_mw",
    )


_HOLES_SQL = """
WITH holes AS (
  SELECT event_id, CASE WHEN user_id % 8 = 0 THEN value END AS solar_mw,
         CASE WHEN user_id % 7 > 1 THEN value END AS demand_mw FROM events)"""


@query(_HOLES_SQL + " SELECT event_id, coalesce(solar_mw, 0) AS solar_mw, demand_mw FROM holes")
def fill_and_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    finite = cleaning.finite_or_null(_holes(spark, sf_dir), ["demand_mw"])
    return cleaning.fill_fuels(finite, ["solar_mw"])


@query(_HOLES_SQL + " SELECT event_id, solar_mw, demand_mw FROM holes WHERE solar_mw IS NOT NULL AND demand_mw IS NOT NULL")
def complete_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    finite = cleaning.finite_or_null(_holes(spark, sf_dir), ["demand_mw"])
    return cleaning.complete_cases(finite, ["solar_mw", "demand_mw"])


# -- filters, labels, codes ------------------------------------------------------------------


@query(EVENT_SQL + " SELECT ba, ts_unix, net_gen_mw FROM panel WHERE ba IN ('click', 'view')")
def filter_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_entities(event_grid(spark, sf_dir), ["click", "view"]).select("ba", "ts_unix", "net_gen_mw")


@query(EVENT_SQL + " SELECT ba, ts_unix, net_gen_mw FROM panel WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'")
def filter_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_time(event_grid(spark, sf_dir), "2024-01-05", "2024-01-12").select("ba", "ts_unix", "net_gen_mw")


@query(EVENT_SQL + " SELECT ba, ts_unix, mismatch_pct IS NOT NULL AS labelled FROM panel WHERE mismatch_label = 0")
def normal_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = reports.normal_hours(event_grid(spark, sf_dir))
    return hours.select("ba", "ts_unix", F.col("mismatch_pct").isNotNull().alias("labelled"))


@query(
    EVENT_SQL
    + f""" SELECT ba, ts_unix, {r4_sql('mismatch_mw')} AS mismatch_mw, {r4_sql('mismatch_pct')} AS mismatch_pct, CAST(mismatch_label AS INT) AS mismatch_label,
 CASE mismatch_label WHEN 0 THEN 'Balanced' WHEN 1 THEN 'Mod Surplus' WHEN 2 THEN 'Sev Surplus' WHEN 3 THEN 'Deficit' END AS severity_class FROM panel"""
)
def mismatch_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_grid(spark, sf_dir).select(
        "ba",
        "ts_unix",
        r4("mismatch_mw").alias("mismatch_mw"),
        r4("mismatch_pct").alias("mismatch_pct"),
        "mismatch_label",
        label_name(F.col("mismatch_label")).alias("severity_class"),
    )


@query(SHIPMENT_SQL + " SELECT ba, CAST(dense_rank() OVER (ORDER BY ba) - 1 AS INT) AS code FROM (SELECT DISTINCT ba FROM panel)")
def entity_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.entity_codes(shipment_grid(spark, sf_dir))


# -- joins -----------------------------------------------------------------------------------


@query(
    EVENT_SQL
    + """, events_in AS (
  SELECT ba, min(ts) + INTERVAL 2 DAY AS a, min(ts) + INTERVAL 5 DAY AS b, 'early' AS name FROM panel GROUP BY ba
  UNION ALL SELECT ba, min(ts) + INTERVAL 4 DAY, max(ts), 'late' FROM panel WHERE ba <> 'view' GROUP BY ba)
SELECT p.ba, p.ts_unix, e.name FROM panel p LEFT JOIN events_in e ON p.ba = e.ba AND p.ts BETWEEN e.a AND e.b"""
)
def event_overlay_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping events per series, found from its first and last hour."""
    panel = event_grid(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).select("ba", "ts", "ts_unix")
    spans = panel.groupBy("ba").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    early = spans.selectExpr("ba", "a + INTERVAL 2 DAY AS start", "a + INTERVAL 5 DAY AS end", "'early' AS name")
    late = spans.where("ba <> 'view'").selectExpr("ba", "a + INTERVAL 4 DAY AS start", "b AS end", "'late' AS name")
    return event_overlay(panel, early.unionByName(late)).select("ba", "ts_unix", "name")


@query(
    EVENT_SQL
    + f""", scored AS (SELECT ba, ts_unix, abs(demand_mw - net_gen_mw) AS anomaly_score FROM panel WHERE demand_mw > net_gen_mw)
SELECT p.ba, p.ts_unix, {r4_sql('s.anomaly_score')} AS anomaly_score
FROM panel p LEFT JOIN scored s ON p.ba = s.ba AND p.ts_unix = s.ts_unix"""
)
def attach_scores_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = event_grid(spark, sf_dir)
    scores = panel.where("demand_mw > net_gen_mw").selectExpr("ba", "ts_unix", "abs(demand_mw - net_gen_mw) AS anomaly_score")
    joined = attach_scores(panel.select("ba", "ts_unix"), scores)
    return joined.select("ba", "ts_unix", r4("anomaly_score").alias("anomaly_score"))


@query(
    EVENT_SQL
    + """ SELECT ba, ts_unix, solar_mw AS actual, lead(solar_mw, 12) OVER (PARTITION BY ba ORDER BY ts_unix) AS forecast FROM panel"""
)
def actual_and_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actual_vs_forecast(add_leads(event_grid(spark, sf_dir)), "solar", 12)


# -- order, samples, splits ------------------------------------------------------------------


@query(EVENT_SQL + " SELECT ba, ts_unix, demand_mw FROM panel ORDER BY ba, ts_unix")
def series_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.in_series_order(event_grid(spark, sf_dir).select("ba", "ts_unix", "demand_mw"))



@query(SHIPMENT_SQL + f" SELECT ba, ts_unix, net_gen_mw FROM panel ORDER BY {SCORE}, ba, ts_unix LIMIT 5000")
def downsample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5,000 rows for display, in time order; an arithmetic score in place of the hash."""
    rows = shipment_grid(spark, sf_dir).select("ba", "ts_unix", "net_gen_mw")
    return sampling.sample_exact(rows, 5000, score=F.expr(SCORE)).orderBy("ts_unix", "ba")


@query(
    SHIPMENT_SQL
    + f""", scored AS (SELECT ba, ts_unix, mismatch_label, {SCORE} AS score FROM panel WHERE mismatch_label IS NOT NULL)
SELECT ba, ts_unix, CAST(mismatch_label AS INT) AS mismatch_label,
       rank() OVER (PARTITION BY mismatch_label ORDER BY score)
         <= floor(count(*) OVER (PARTITION BY mismatch_label) * 0.15 + 0.5) AS held_out FROM scored"""
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = durable(shipment_grid(spark, sf_dir).select("ba", "ts_unix", "mismatch_label"))
    return sampling.mark_holdout(rows, "mismatch_label", 0.15, score=F.expr(SCORE))


@query(
    EVENT_SQL
    + """ SELECT ba, ts_unix, ts_unix > (SELECT max(ts_unix) - (max(ts_unix) - min(ts_unix)) * CAST(0.15 AS DOUBLE) FROM panel) AS held_out FROM panel"""
)
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held = sampling.split_by_time(event_grid(spark, sf_dir).select("ba", "ts_unix"), 0.15)
    return train.withColumn("held_out", F.lit(False)).unionByName(held.withColumn("held_out", F.lit(True)))


_ENTITY_FRACTION = "(CAST(substr(ba, 2) AS BIGINT) * 7919 % 1009) / 1009"


@query(
    SHIPMENT_SQL
    + f""" SELECT CASE WHEN {FRACTION} < 0.15 THEN 'held out' ELSE 'train' END AS part, count(*) AS rows,
 {r4_sql('avg(net_gen_mw)')} AS avg_net_gen_mw FROM panel GROUP BY 1"""
)
def key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held = sampling.split_by_key(shipment_grid(spark, sf_dir), 0.15, score=F.expr(FRACTION))
    parts = train.select(F.lit("train").alias("part"), "net_gen_mw").unionByName(held.select(F.lit("held out").alias("part"), "net_gen_mw"))
    return parts.groupBy("part").agg(F.count("*").alias("rows"), r4(F.avg("net_gen_mw")).alias("avg_net_gen_mw"))


@query(SHIPMENT_SQL + f" SELECT ba, count(*) AS rows FROM panel WHERE {_ENTITY_FRACTION} < 0.2 GROUP BY ba")
def entity_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sampling.sample_entities(shipment_grid(spark, sf_dir), 0.2, score=F.expr(_ENTITY_FRACTION))
    return kept.groupBy("ba").agg(F.count("*").alias("rows"))


@query(SHIPMENT_SQL + f" SELECT ba, ts_unix, net_gen_mw FROM panel WHERE {FRACTION} < 0.2")
def row_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_rows(shipment_grid(spark, sf_dir), 0.2, score=F.expr(FRACTION)).select("ba", "ts_unix", "net_gen_mw")


_SCALED = ", ".join(
    f"avg({s}) FILTER (WHERE mismatch_label = 0) AS m{i}, stddev_pop({s}) FILTER (WHERE mismatch_label = 0) AS d{i}"
    for i, s in enumerate(S.SEQUENCE_SIGNALS)
)


@query(
    EVENT_SQL
    + f", scales AS (SELECT {_SCALED} FROM panel) SELECT ba, ts_unix, "
    + ", ".join(
        r4_sql(f"({s} - m{i}) / CASE WHEN d{i} > 0 THEN d{i} ELSE 1 END") + f" AS {s}" for i, s in enumerate(S.SEQUENCE_SIGNALS)
    )
    + " FROM panel, scales"
)
def standardise_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = event_grid(spark, sf_dir)
    scaled = standardise(panel, signal_scales(reports.normal_hours(panel)))
    return scaled.select("ba", "ts_unix", *[r4(s).alias(s) for s in S.SEQUENCE_SIGNALS])
