import pytest
from pyspark.sql import functions as F

from hourloom.__main__ import main
from hourloom.functions import schema as S
from hourloom.plans.features import build_features, sampled
from hourloom.sources import raw, tables


def _write(path, header, rows):
    path.write_text("\n".join([",".join(header), *(",".join(r) for r in rows)]) + "\n")


@pytest.fixture
def raw_dir(tmp_path):
    """Three half-years with different column order, one of them without wind, one nearly empty."""
    directory = tmp_path / "raw"
    directory.mkdir()
    time, ba, demand, net, solar, wind = (
        S.SOURCE_HEADERS[c] for c in ("ts_utc", "ba", "demand_mw", "net_gen_mw", "solar_mw", "wind_mw")
    )
    clock = [f"{h % 12 or 12}:00:00 {'AM' if h < 12 else 'PM'}" for h in range(24)]
    _write(
        directory / "EIA930_BALANCE_2020_Jul_Dec.csv",
        [time, ba, demand, net, solar, wind, "Region"],
        [[f"12/31/2020 {c}", b, '"1,000"', str(1000 + i), str(i), "5", "X"] for b in ("AAA", "BBB") for i, c in enumerate(clock)],
    )
    _write(
        directory / "EIA930_BALANCE_2021_Jan_Jun.csv",
        [ba, f" {time.upper()} ", solar, net, demand, "Demand (MW)"],
        [[b, f"01/01/2021 {c}", str(i), "900", "1000", "7"] for b in ("AAA", "BBB") for i, c in enumerate(clock)]
        + [["AAA", "12/31/2020 1:00:00 AM", "77", "77", "77", "7"]],
    )
    _write(directory / "EIA930_BALANCE_2021_Jul_Dec.csv", [time, ba, demand, net, solar, wind, "Region"], [])
    (directory / "notes.txt").write_text("not a raw file")
    return str(directory)


def test_manifest(spark):
    rows = raw.manifest(spark).collect()
    assert len(rows) == 12
    assert rows[0].file_name == "EIA930_BALANCE_2019_Jan_Jun.csv" and rows[-1].file_name == "EIA930_BALANCE_2024_Jul_Dec.csv"


def test_coverage(spark, raw_dir):
    audit = raw.coverage_audit(spark, raw_dir, 2020, 2021, min_bytes=1000)
    assert {r.file_name[15:22]: r.status for r in audit.collect()} == {"2020_Ja": "missing", "2020_Ju": "ok", "2021_Ja": "ok", "2021_Ju": "tiny"}
    totals = {r.status: r.files for r in raw.audit_totals(audit).collect()}
    assert totals == {"missing": 1, "ok": 2, "tiny": 1}


def test_coverage_of_an_empty_directory(spark, tmp_path):
    assert {r.status for r in raw.coverage_audit(spark, str(tmp_path)).collect()} == {"missing"}


def test_files_with_one_header_share_a_scan(spark, raw_dir):
    frames = raw.read_raw_files(spark, raw.list_raw_files(spark, raw_dir))
    assert len(frames) == 2
    assert sum(f.count() for f in frames) == 97
    both = raw.union_frames(frames)
    assert both.where("ts_utc LIKE '01/01/2021%' AND solar_mw = '3'").count() == 2
    assert both.where("wind_mw IS NULL").count() == 49
    assert [r.ba for r in raw.distinct_entities(frames).orderBy("ba").collect()] == ["AAA", "BBB"]
    with pytest.raises(FileNotFoundError):
        raw.read_raw_files(spark, [])


def test_schema_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, c string")
    assert [tuple(r) for r in raw.schema_report(df).collect()] == [(0, "a.b", "int", 2), (1, "c", "string", 1)]


def test_raw_files_to_features(spark, raw_dir, tmp_path):
    panel_path, feature_path = str(tmp_path / "panel"), str(tmp_path / "features")
    features = build_features(spark, raw_dir, panel_path, feature_path)
    assert features.count() == 96 and len(features.columns) == 193
    row = features.where("ba = 'AAA' AND ts_utc = '01/01/2021 12:00:00 AM'").first()
    assert (row.solar_mw, row.solar_lag_1h, row.solar_t6h_ahead, row.mismatch_label, row.wind_mw) == (0.0, 23.0, 6.0, 3, 0.0)
    # The later file gives the hour that both files have.
    assert features.where("ba = 'AAA' AND ts_utc = '12/31/2020 1:00:00 AM'").first().demand_mw == 77.0
    only = tables.load(spark, feature_path, ["ba", "solar_mw", "year", "nothing"]).where("ba = 'AAA' AND year = 2021")
    assert only.columns == ["ba", "solar_mw", "year"] and only.count() == 24
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ba" in plan and "ReadSchema: struct<solar_mw:double>" in plan


def test_partitioned_write_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20).selectExpr("int(2020 + id % 2) AS year", "concat('b', id % 3) AS ba", "id")
    tables.write_partitioned(df, path)
    tables.write_partitioned(df.where("id < 12"), path)
    assert tables.load(spark, path).count() == 12
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"year=2020", "year=2021"}


def test_series_named_by_numbers_stay_text(spark, tmp_path):
    df = spark.createDataFrame([("007", 2020), ("1e3", 2020)], "ba string, year int")
    tables.write_partitioned(df.withColumn("v", F.lit(1.0)), str(tmp_path / "t"))
    back = tables.load(spark, str(tmp_path / "t"), ["ba", "year"])
    assert sorted(tuple(r) for r in back.collect()) == [("007", 2020), ("1e3", 2020)]


def test_scores_without_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 0.5, "x"), ("a", 2, None, "y")], "ba string, ts_unix bigint, anomaly_score double, more string")
    tables.write_scores(df, str(tmp_path / "s"))
    back = tables.load(spark, str(tmp_path / "s"))
    assert back.count() == 1 and back.columns == ["ba", "ts_unix", "anomaly_score"]


def test_sampling_modes(spark, panel):
    assert sampled(panel, 1.0).count() == panel.count()
    some = sampled(panel, 0.5)
    kept = {r.ba for r in some.select("ba").distinct().collect()}
    assert some.count() == panel.where(F.col("ba").isin(list(kept))).count()
    with pytest.raises(ValueError):
        sampled(panel, 0.5, "other")


def test_command_line(spark, raw_dir, tmp_path, capsys):
    main(["audit", raw_dir])
    main(["features", raw_dir, str(tmp_path / "p"), str(tmp_path / "f")])
    main(["train", "severity", str(tmp_path / "f"), str(tmp_path / "m")])
    printed = capsys.readouterr().out
    assert "EIA930_BALANCE_2019_Jan_Jun.csv" in printed and "mismatch_label" in printed


def test_raw_files_of_other_years_are_listed(spark, raw_dir):
    audit = {r.file_name[15:22]: (r.year, r.status) for r in raw.coverage_audit(spark, raw_dir, 2021, 2021, min_bytes=1000).collect()}
    assert audit == {"2020_Ju": (None, "unexpected"), "2021_Ja": (2021, "ok"), "2021_Ju": (2021, "tiny")}


def test_options_of_the_command_line(spark, raw_dir, tmp_path, capsys):
    main(["audit", raw_dir, "--first-year", "2020", "--last-year", "2020"])
    assert "unexpected" in capsys.readouterr().out
    main(["features", raw_dir, str(tmp_path / "p"), str(tmp_path / "f"), "--lag-mode", "time"])
    assert spark.read.parquet(str(tmp_path / "p-rejects")).where("column = 'ts_utc'").count() == 1
    main(["train", "forecast", str(tmp_path / "f"), str(tmp_path / "m"), "--split", "time", "--stop-early"])
    main(["train", "anomaly", str(tmp_path / "f"), str(tmp_path / "m"), "--contiguous"])
