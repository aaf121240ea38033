"""No row is lost and no number is made up: missing times, shared prefixes, odd number texts, pruned time ranges."""

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from hourloom.functions.scalar import parse_number
from hourloom.operators.cleaning import finite_or_null
from hourloom.operators.labels import entity_codes
from hourloom.operators.reports import filter_time, histogram
from hourloom.operators.sampling import sample_entities, sample_exact, sample_rows, split_by_key
from hourloom.operators.windows import add_lags, hourly_grid
from hourloom.queries.grids import _cells, _signals


def test_rows_without_a_time_stay(spark, panel):
    missing = panel.limit(3).withColumn("ts_unix", F.lit(None).cast("long"))
    whole = panel.unionByName(missing)
    assert add_lags(whole).count() == panel.count() + 3


def test_names_of_one_prefix_are_numbered_in_order(spark):
    names = spark.range(3000).select(F.format_string("zone-%05d", "id").alias("ba"))
    rows = entity_codes(names).orderBy("ba").collect()
    assert [r["code"] for r in rows] == list(range(3000))


def test_only_numbers_are_numbers(spark):
    texts = spark.createDataFrame([(t,) for t in ("NaN", "5d", "1,234.5", "-1e3", "", "Infinity", ".5", "7.")], "t string")
    assert [r[0] for r in texts.select(parse_number(F.col("t"))).collect()] == [None, None, 1234.5, -1000.0, None, None, 0.5, 7.0]
    assert finite_or_null(spark.sql("SELECT double('NaN') AS a, 1.0D AS b"), ["a", "b"]).first() == (None, 1.0)


def test_one_nan_leaves_the_histogram_alone(spark):
    scores = spark.range(50).select(F.col("id").cast("double").alias("s"))
    odd = scores.unionByName(spark.sql("SELECT double('NaN') AS s"))
    assert sorted(histogram(odd, "s", 5).collect()) == sorted(histogram(scores, "s", 5).collect())


def test_time_ranges_prune_a_stored_table(spark, tmp_path):
    rows = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 86400 + 1_500_000_000).alias("ts"), (F.col("id") * 86400 + 1_500_000_000).alias("ts_unix"))
    rows.withColumn("year", F.year("ts")).write.partitionBy("year").parquet(str(tmp_path / "t"))
    cut = filter_time(spark.read.parquet(str(tmp_path / "t")), "2018-03-01", "2018-03-31")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert cut.count() == 30 and "year" in plan.split("PartitionFilters")[1].split("]")[0] and "ts_unix" in plan.split("PushedFilters")[1]


def test_hourly_grid_keeps_rows_off_the_hour_and_without_keys(spark):
    rows = [("a", 1800), ("a", 7200), ("a", 10800), ("a", 10801), ("b", 5), (None, 3600), ("c", None)]
    panel = spark.createDataFrame([(*r, float(i)) for i, r in enumerate(rows)], "ba string, ts_unix bigint, solar_mw double")
    got = {(r.ba, r.ts_unix): r.solar_mw for r in hourly_grid(panel).collect()}
    assert got == {**{r: float(i) for i, r in enumerate(rows)}, ("a", 3600): None}


def test_exact_sample_cuts_before_it_orders(spark):
    df = spark.range(1000).selectExpr("concat('s', id % 3) AS ba", "id AS ts_unix", "id DIV 7 AS s")
    picked = sample_exact(df, 40, score=F.col("s"))
    assert sorted(r.ts_unix for r in picked.collect()) == [*range(38), 39, 40] and picked.columns == df.columns
    plan = picked._jdf.queryExecution().optimizedPlan().toString()
    assert "__score" in plan and "scalar-subquery" in plan
    assert sample_exact(df, 5000).count() == 1000 and sample_exact(df, 0).count() == 0 and sample_exact(df.limit(0), 5).count() == 0


def test_samples_and_splits_by_a_score(spark):
    df = spark.range(10).selectExpr("'x' AS ba", "id AS ts_unix", "CASE WHEN id < 8 THEN id / 10.0 END AS s")
    train, held = split_by_key(df, 0.35, score=F.col("s"))
    assert held.count() == 4 and train.count() == 6
    assert sample_rows(df, 0.2, score=F.col("s")).count() == sample_entities(df, 0.2, score=F.col("s")).count() == 2


def test_exact_sample_counts_stored_scores(spark):
    df = spark.range(100).selectExpr("concat('s', id % 3) AS ba", "id AS ts_unix", "1 AS v").groupBy("ba", "ts_unix").count()
    plan = sample_exact(df, 40, score=F.expr("ts_unix * 7 % 31"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [ba") == 1


def test_cells_are_exact_sums_of_any_size(spark):
    values = [0.1, 0.2, -0.35, 1.005, 9e13, 9e13, -1e-9, None, 12345678901.25]
    rows = [("a", 8 * i, v) for i, v in enumerate(values)] + [("b", 8, None), ("c", 15, 0.07), ("c", None, 0.2)]
    cells = _cells(spark.createDataFrame(rows, "k string, u bigint, v double"), "k", "1", "v", "u")
    got = {r.ba: (r.net_gen_mw, r.solar_mw, r.other_mw, r.demand_mw) for r in _signals(cells.withColumn("ts", F.lit("2024-01-01")), 1).collect()}
    cents = sum((Decimal(repr(v)).quantize(Decimal("0.01"), ROUND_HALF_UP) for v in values if v is not None), Decimal(0))
    assert got["a"] == (float(cents), float(cents), 0.0, float(cents - cents * Decimal("0.2")))
    assert got["b"] == (None, 0.0, 0.0, None) and got["c"] == (0.27, 0.0, 0.07, 0.284)
