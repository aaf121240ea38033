import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators.neighbours import BLOCK, HOME, SERIES, over_series, with_neighbours
from hourloom.operators.windows import add_lags, add_leads, add_rolling, feature_table, hourly_grid, rolling_columns, sequences
from hourloom.queries.analysis import _steps


def _same(a, b):
    columns = a.columns
    b = b.select(*columns)
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@pytest.mark.parametrize("block_days", [1, 4, 180])
def test_blocks_equal_whole_series(spark, panel, block_days):
    w = Window.partitionBy("ba").orderBy("ts_unix")
    expected = panel.select(
        "ba",
        "ts_unix",
        *[F.lag(f"{s}_mw", h).over(w).alias(S.lag_name(s, h)) for s in S.HISTORY_SIGNALS for h in (1, 17, 48)],
        *[F.lead(f"{s}_mw", h).over(w).alias(S.lead_name(s, h)) for h in S.LEAD_HOURS for s in S.LEAD_SIGNALS],
        *[
            function(f"{s}_mw").over(w.rangeBetween(-(hours - 1) * 3600, 0)).alias(S.rolling_name(s, label, name))
            for label, hours in S.ROLLING_HOURS.items()
            for s in S.HISTORY_SIGNALS
            for name, function in (("mean", F.avg), ("std", F.stddev_pop))
        ],
    )
    built = feature_table(panel, block_days=block_days)
    _same(_rounded(built.select(*expected.columns)), _rounded(expected))


def test_feature_table_has_all_columns_and_rows(spark, panel):
    features = feature_table(panel)
    added = set(features.columns) - set(panel.columns)
    assert added == {*S.LAG_COLUMNS, *S.ROLLING_COLUMNS, *S.LEAD_COLUMNS, *S.MISMATCH_COLUMNS}
    assert len(added) == 171
    assert features.count() == panel.count()
    assert dict(features.dtypes)["mismatch_label"] == "int"


def test_row_order_does_not_matter(spark, panel):
    shuffled = panel.orderBy(F.xxhash64("ts_unix", "ba")).repartition(3)
    _same(_rounded(add_rolling(panel, block_days=3)), _rounded(add_rolling(shuffled, block_days=7)))


def test_lag_of_lead_is_the_value(spark, panel):
    led = add_leads(panel, block_days=2).select("ba", "ts_unix", "wind_mw", F.col("solar_t6h_ahead").alias("solar_mw"), "demand_mw", F.col("solar_mw").alias("now"))
    back = add_lags(led, block_days=3)
    assert back.where("solar_lag_6h IS NOT NULL AND solar_lag_6h <> now").isEmpty()


def test_row_lag_steps_over_gaps_and_time_lag_does_not(spark):
    rows = [("a", h * 3600, float(h), 0.0, 0.0) for h in (0, 1, 4, 5)]
    df = spark.createDataFrame(rows, "ba string, ts_unix bigint, solar_mw double, wind_mw double, demand_mw double")
    by_row = {r.ts_unix // 3600: r.solar_lag_1h for r in add_lags(df).collect()}
    by_time = {r.ts_unix // 3600: r.solar_lag_1h for r in add_lags(df, mode="time").collect()}
    assert by_row == {0: None, 1: 0.0, 4: 1.0, 5: 4.0}
    assert by_time == {0: None, 1: 0.0, 4: None, 5: 4.0}
    with pytest.raises(ValueError):
        add_lags(df, mode="other")


def test_time_lag_equals_row_lag_on_a_filled_grid(spark, panel):
    few = panel.where("ba IN ('a', 'f')").select("ba", "ts_unix", "solar_mw", "wind_mw", "demand_mw")
    filled = add_lags(hourly_grid(few), block_days=9).join(few.select("ba", "ts_unix"), ["ba", "ts_unix"], "left_semi")
    _same(add_lags(few, mode="time", block_days=9), filled)


def test_one_row_has_zero_deviation(spark, panel):
    row = add_rolling(panel.where("ba = 'f'").fillna(3.0)).first()
    assert row.solar_roll7d_std == 0.0


@pytest.mark.parametrize("length,block_days", [(5, 1), (168, 6)])
def test_sequences(spark, panel, length, block_days):
    built = sequences(panel.fillna(0.0), length=length, block_days=block_days)
    w = Window.partitionBy("ba").orderBy("ts_unix")
    expected = (
        panel.fillna(0.0)
        .select("ba", "ts_unix", F.flatten(F.collect_list(F.array(*S.SEQUENCE_SIGNALS)).over(w.rowsBetween(1 - length, 0))).alias("sequence"))
        .where(F.size("sequence") == 5 * length)
    )
    _same(built, expected)


def test_contiguous_sequences_have_no_gap(spark, panel):
    w = Window.partitionBy("ba").orderBy("ts_unix")
    expected = panel.withColumn("gone", F.col("ts_unix") - F.lag("ts_unix", 2).over(w)).where("gone = 7200").count()
    assert sequences(panel.fillna(0.0), length=3, contiguous=True).count() == expected


def test_a_hot_series_is_split_into_bounded_blocks(spark):
    hot = spark.range(40_000).selectExpr("IF(id < 30000, 'hot', concat('s', id % 9)) AS ba", "id * 3600 AS ts_unix", "double(id) AS solar_mw")
    reached = with_neighbours(hot, back_rows=48, ahead_rows=24, back_seconds=167 * 3600)
    sizes = reached.groupBy(SERIES, BLOCK).agg(F.count("*").alias("n"), F.count_if(HOME).alias("home"))
    most = sizes.agg(F.max("n"), F.max("home"), F.sum("home")).first()
    assert most[0] <= (180 + 9) * 24 and most[1] <= 180 * 24 and most[2] == 40_000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_table_shuffles_and_sorts_once(spark):
    hourly = spark.range(5000).selectExpr(
        "concat('s', id % 2) AS ba", "(id DIV 2) * 3600 AS ts_unix", "double(id) AS solar_mw", "double(id) AS wind_mw",
        "double(id) AS demand_mw", "double(id) AS net_gen_mw",
    )
    plan = _plan(feature_table(hourly))
    assert plan.count("Exchange hashpartitioning(ba") == 1
    assert plan.count("Window [") == 1 and plan.count("Sort [") == 1 and "Join" not in plan


def test_unused_columns_are_not_computed(spark, panel):
    plan = _plan(feature_table(panel).select("ba", "ts_unix", "wind_lag_7h", "solar_roll24h_mean"))
    assert plan.count("avg(") == 1 and "stddev" not in plan and "lead(" not in plan.split("Window [")[1]
    assert plan.count("try_element_at") == 1 or "__history" in plan
    assert "demand_mw" not in plan.split("Window [")[-1].split("Exchange hashpartitioning(ba")[0]


def test_rolling_in_blocks_equals_window_frames_over_many_batches(spark, panel):
    spike = panel.withColumn("wind_mw", F.when(F.col("ts_unix") % 97 == 0, 1e5).otherwise(F.col("wind_mw")))
    alone = spike.limit(2).withColumn("ts_unix", F.lit(None).cast("long"))
    whole = spike.unionByName(alone).unionByName(spike.limit(5).withColumn("ba", F.lit(None).cast("string")))
    expected = over_series(whole, rolling_columns(), back_seconds=167 * 3600, block_days=3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        built = add_rolling(whole, block_days=3)
        ordered = [sorted((tuple(r) for r in df.select(*expected.columns).collect()), key=lambda r: tuple(map(str, r[: len(panel.columns)]))) for df in (built, expected)]
        assert len(ordered[0]) == len(ordered[1]) == whole.count()
        for ours, theirs in zip(*ordered):
            assert [x is None for x in ours] == [x is None for x in theirs]
            assert all(x == y or abs(x - y) <= 1e-6 + 1e-9 * abs(y) for x, y in zip(ours, theirs) if x is not None)
        assert "Window [" not in _plan(built) and built.columns == expected.columns
        assert "solar_roll6h_std" not in add_rolling(whole, statistics=["mean"]).columns
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_leads_of_steps_sum_no_other_signals(spark):
    plan = _steps(spark, "/root/testdata/sf0.001", S.LEAD_SIGNALS)._jdf.queryExecution().optimizedPlan().toString()
    assert "solar_high" in plan and "coal_high" not in plan and "net_high" not in plan
