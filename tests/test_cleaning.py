import pytest
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.functions.scalar import label_name, mismatch_pct, parse_number, parse_timestamp, severity_label
from hourloom.operators import cleaning
from hourloom.operators.labels import add_labels, entity_codes
from hourloom.operators.reports import filter_entities, filter_time


def test_headers_match_after_trim_and_lower_case(spark):
    raw = spark.createDataFrame(
        [("t", "A", "1", "raw", "imputed", "region", "5", "6")],
        [
            " utc time at END of hour", "Balancing Authority ", "Demand (MW) (Adjusted)", "Demand (MW)", "Demand (MW) (Imputed)",
            "Region", "Net Generation (MW) from Unknown Fuel Sources (Adjusted)", "wind_mw",
        ],
    )
    row = cleaning.normalise_columns(raw).first().asDict()
    assert set(row) == set(S.SOURCE_HEADERS)
    filled = {k: v for k, v in row.items() if v is not None}
    assert filled == {"ts_utc": "t", "ba": "A", "demand_mw": "1", "unknown_mw": "5", "wind_mw": "6"}


def test_two_headers_of_one_name_are_merged(spark):
    raw = spark.createDataFrame([(None, "x"), ("y", "z")], ["Balancing Authority", " balancing authority"])
    assert [r.ba for r in cleaning.normalise_columns(raw).collect()] == ["x", "y"]


def test_numbers_and_times(spark):
    texts = ["1,234.5", " 7 ", "", "abc", "-3", "1e3", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(parse_number(F.col("t"))).collect()] == [1234.5, 7.0, None, None, -3.0, 1000.0, None]
    times = ["03/14/2021 2:00:00 AM", "03/14/2021 3:00:00 AM", "12/31/2020 12:00:00 AM", "12/31/2020 12:00:00 PM", "1/2/2020 1:00:00 PM", "garbage", ""]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    got = [r[0] for r in df.select(F.unix_timestamp(parse_timestamp(F.col("t")))).collect()]
    assert got[1] - got[0] == 3600 and got[3] - got[2] == 12 * 3600
    assert got[4] == 1577970000 and got[5:] == [None, None]


def test_calendar_counts_sunday_as_1_and_iso_weeks(spark):
    df = spark.createDataFrame([("01/03/2021 5:00:00 AM",), ("12/31/2018 5:00:00 AM",)], "ts_utc string")
    rows = cleaning.add_calendar(df).collect()
    assert [(r.day_of_week, r.week_of_year, r.hour_of_day) for r in rows] == [(1, 53, 5), (2, 1, 5)]


def _text(spark, rows):
    raw = spark.createDataFrame(rows, "ts_utc string, ba string, demand_mw string, solar_mw string, source_file string")
    return cleaning.normalise_columns(raw)


def test_clean_panel(spark):
    t, u = "01/01/2021 1:00:00 AM", "01/01/2021 2:00:00 AM"
    text = _text(
        spark,
        [
            (t, "A", "10", "1", "2021_a"),
            (t, "A", "20", None, "2021_b"),
            (t, "A", "15", "9", "2021_b"),
            ("1/1/2021 1:00:00 AM", "A", "99", "9", "2020"),
            (u, None, "1", "1", "x"),
            (None, "A", "1", "1", "x"),
            ("never", "A", "1", "1", "x"),
            (u, "A", "", "", "x"),
        ],
    )
    rows = cleaning.clean_panel(text).orderBy("ts_unix").collect()
    assert [(r.ba, r.demand_mw, r.solar_mw, r.coal_mw, r.unknown_mw) for r in rows] == [("A", 20.0, 0.0, 0.0, None), ("A", None, 0.0, 0.0, None)]
    assert cleaning.clean_panel(text).schema.simpleString() == S.PANEL_SCHEMA.simpleString()


def test_rejects_are_counted(spark):
    text = _text(spark, [("never", "A", "1,0", "x", "f"), ("01/01/2021 1:00:00 AM", "A", "", "2", "f")])
    found = {r["column"]: (r.filled, r.rejected) for r in cleaning.reject_counts(text).collect()}
    assert found["ts_utc"] == (2, 1) and found["demand_mw"] == (1, 0) and found["solar_mw"] == (2, 1) and found["oil_mw"] == (0, 0)


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(10_000).selectExpr("'hot' AS ba", "CAST(id % 3 AS STRING) AS ts_utc", "double(id) AS demand_mw", "'f' AS source_file")
    unique = cleaning.dedup_latest(df)
    assert sorted(r.demand_mw for r in unique.collect()) == [9997.0, 9998.0, 9999.0]
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_infinities_and_complete_cases(spark):
    rows = [(1, float("inf"), 1.0), (2, float("-inf"), None), (3, 5.0, 2.0), (4, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    finite = cleaning.finite_or_null(df, ["a"])
    assert [r.id for r in finite.where("a IS NULL").collect()] == [1, 2, 4]
    assert [r.id for r in cleaning.complete_cases(finite, ["a", "b"]).collect()] == [3]


@pytest.mark.parametrize(
    "generation,demand,label",
    [(95, 100, 0), (94.99, 100, 3), (105, 100, 0), (105.01, 100, 1), (120, 100, 1), (120.01, 100, 2), (1, 0, None), (None, 5, None), (5, None, None), (90, -100, 3)],
)
def test_labels(spark, generation, demand, label):
    df = spark.createDataFrame([(generation and float(generation), None if demand is None else float(demand))], "net_gen_mw double, demand_mw double")
    row = add_labels(df).first()
    assert row.mismatch_label == label
    if generation is not None and demand is not None:
        assert row.mismatch_mw == pytest.approx(generation - demand)


def test_label_names(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 2, 3, None)], "l int")
    assert [r[0] for r in df.select(label_name(F.col("l"))).collect()] == ["Balanced", "Mod Surplus", "Sev Surplus", "Deficit", None]


def test_nan_is_a_severe_surplus(spark):
    pct = mismatch_pct(F.lit(float("nan")), F.lit(1.0))
    assert spark.range(1).select(severity_label(pct)).first()[0] == 2


def test_entity_codes(spark):
    names = ["b", "a", "ab", "aba", "abb", "ba", None, "a", "é"]
    df = spark.createDataFrame([(n,) for n in names], "ba string")
    got = {r.ba: r.code for r in entity_codes(df).collect()}
    assert got == {n: i for i, n in enumerate(sorted({n for n in names if n}))}


def test_filters(spark):
    df = spark.createDataFrame([("a", "2021-01-01 00:00:00"), ("b", "2021-01-02 00:00:00"), ("b", "2021-01-02 05:00:00")], "ba string, ts string")
    df = df.withColumn("ts", F.to_timestamp("ts"))
    assert filter_entities(df, []).count() == 3 and filter_entities(df, ["a"]).count() == 1
    assert filter_time(df, "2021-01-01", "2021-01-02").count() == 2
    assert filter_time(df, "2021-01-01", "2021-01-02", whole_last_day=True).count() == 3
