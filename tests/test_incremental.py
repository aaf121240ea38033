"""Updates of panel and features against full builds, and headers of many files in as many jobs as of few."""

import os
import random

import pytest
from pyspark.sql import functions as F

from hourloom.__main__ import main
from hourloom.functions import schema as S
from hourloom.plans.features import build_features
from hourloom.plans.incremental import file_changes, listed_files, reached_years, update_features
from hourloom.sources import raw, tables

HEADER = [S.SOURCE_HEADERS[c] for c in ("ts_utc", "ba", "demand_mw", "net_gen_mw", "solar_mw", "wind_mw")]


def _raw(directory, year, half, series, seed, days=(1, 2), extra=()):
    """Hours of the first days and of the last day of a half-year, with gaps."""
    rng = random.Random(seed)
    months = (1, 6) if half == "Jan_Jun" else (7, 12)
    lines = [",".join(HEADER)]
    for ba in series:
        for month, day in [(months[0], d) for d in days] + [(months[1], 30)]:
            for h in range(24):
                if rng.random() < 0.9:
                    clock = f"{h % 12 or 12}:00:00 {'AM' if h < 12 else 'PM'}"
                    lines.append(",".join([f"{month:02d}/{day:02d}/{year} {clock}", ba, *(str(rng.randint(0, 900)) for _ in range(4))]))
    path = directory / f"EIA930_BALANCE_{year}_{half}.csv"
    path.write_text("\n".join([*lines, *extra]) + "\n")


def _same(spark, path, other):
    here, there = tables.load(spark, path), tables.load(spark, other)
    assert sorted(here.columns) == sorted(there.columns)
    here, there = here.select(sorted(there.columns)), there.select(sorted(there.columns))
    assert here.count() == there.count() > 0
    assert here.exceptAll(there).isEmpty() and there.exceptAll(here).isEmpty()


def test_updates_equal_full_builds(spark, tmp_path):
    directory = tmp_path / "raw files"
    directory.mkdir()
    for i, (year, half) in enumerate([(2018, "Jan_Jun"), (2019, "Jan_Jun"), (2019, "Jul_Dec"), (2020, "Jan_Jun"), (2023, "Jul_Dec")]):
        # few rows in 2019, so that windows reach over it
        _raw(directory, year, half, ["AAA", "B B", "007"] if year != 2019 else ["AAA"], i, days=(1, 2) if year != 2019 else ())
    names = [str(tmp_path / n) for n in ("panel", "features")]

    def updated():
        return {r.file_name[15:22]: r.change for r in update_features(spark, str(directory), *names).collect()}

    def check():
        full = [str(tmp_path / f"full-{n}-{len(os.listdir(tmp_path))}") for n in ("panel", "features")]
        build_features(spark, str(directory), *full)
        for ours, theirs in zip(names, full):
            _same(spark, ours, theirs)

    assert set(updated().values()) == {"new"}
    assert set(updated().values()) == {"same"}
    kept = {p for p in (tmp_path / "features" / "year=2023").rglob("*.parquet")}
    # one replaced (a series less, one more, an hour of another year), one new, one removed
    _raw(directory, 2020, "Jan_Jun", ["AAA", "new"], 50, extra=["01/01/2018 5:00:00 AM,AAA,1,2,3,4"])
    _raw(directory, 2020, "Jul_Dec", ["AAA"], 51)
    (directory / "EIA930_BALANCE_2019_Jul_Dec.csv").unlink()
    changes = updated()
    assert changes["2020_Ja"] == "replaced" and changes["2020_Ju"] == "new" and changes["2019_Ju"] == "removed" and changes["2023_Ju"] == "same"
    check()
    assert not [p for p in (tmp_path / "features").rglob("*") if p.name == "ba=B%20B" and "year=2020" in str(p) or p.name == "ba=B B" and "year=2020" in str(p)]
    (directory / "EIA930_BALANCE_2020_Jan_Jun.csv").unlink()
    (directory / "EIA930_BALANCE_2020_Jul_Dec.csv").unlink()
    assert list(updated().values()).count("removed") == 2
    check()
    assert kept


def test_untouched_years_are_not_written(spark, tmp_path):
    directory = tmp_path / "raw"
    directory.mkdir()
    for year in (2015, 2016, 2017, 2018):
        _raw(directory, year, "Jan_Jun", ["AAA"], year)
    names = [str(tmp_path / n) for n in ("panel", "features")]
    update_features(spark, str(directory), *names)
    stamps = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "features").rglob("*.parquet")}
    before = stamps()
    _raw(directory, 2015, "Jan_Jun", ["AAA"], 99)
    main(["update", str(directory), *names])
    after = stamps()
    assert {p for p in before if "year=2017" in p or "year=2018" in p} <= {p for p in after if before.get(p) == after[p]}
    assert not {p for p in before if "year=2015" in p or "year=2016" in p} & set(after)
    assert update_features(spark, str(directory), *names).where("change <> 'same'").isEmpty()


def test_reached_years(spark):
    rows = [("a", 2010, 100), ("a", 2011, 10), ("a", 2013, 30), ("a", 2014, 30), ("a", 2016, 5), ("b", 2009, 5), ("b", 2016, 5)]
    panel = spark.createDataFrame(rows, "ba string, year int, n int").select("ba", "year", F.explode(F.sequence(F.lit(1), "n")))
    assert reached_years(panel, [2011], 48, 24) == [2009, 2010, 2011, 2013, 2014, 2016]
    assert reached_years(panel.where("ba = 'a'"), [2011], 48, 24) == [2010, 2011, 2013, 2014]
    assert reached_years(panel.where("ba = 'a'"), [2011], 1, 1) == [2010, 2011, 2013]
    assert reached_years(panel.where("ba = 'a'"), [2016], 48, 24) == [2014, 2016]


def test_changes(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        update_features(spark, str(tmp_path), str(tmp_path / "p"), str(tmp_path / "f"))
    for name in ("a", "b", "c"):
        (tmp_path / f"EIA930_BALANCE_{name}.csv").write_text(name * 5)
    before = listed_files(spark, str(tmp_path)).withColumn("years", F.array(F.lit(2000)))
    before = spark.createDataFrame(before.collect(), before.schema)
    (tmp_path / "EIA930_BALANCE_b.csv").write_text("longer than before")
    (tmp_path / "EIA930_BALANCE_c.csv").unlink()
    (tmp_path / "EIA930_BALANCE_d.csv").write_text("d")
    found = {r.file_name[15]: r.change for r in file_changes(listed_files(spark, str(tmp_path)), before).collect()}
    assert found == {"a": "same", "b": "replaced", "c": "removed", "d": "new"}


def _jobs(spark, build):
    """Jobs that ``build`` starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        build()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_headers_of_many_files_take_no_more_jobs(spark, tmp_path):
    counts = []
    for n in (5, 80, 160):
        directory = tmp_path / f"raw {n}"
        directory.mkdir()
        for i in range(n):
            header = HEADER if i % 2 else HEADER[::-1]
            (directory / f"EIA930_BALANCE_{1900 + i}_Jan_Jun.csv").write_text("\n \n" * (i % 3) + ",".join(header) + "\r\n" + ",".join("123456") + "\r\n" * 2)
        (directory / "EIA930_BALANCE_1800_Jan_Jun.csv").write_text("")
        paths = raw.list_raw_files(spark, str(directory))
        frames = []
        counts.append(_jobs(spark, lambda: frames.extend(raw.read_raw_files(spark, paths))))
        assert len(frames) == 2 and raw.union_frames(frames).where("ba IN ('2', '5') AND wind_mw IN ('1', '6')").count() == n
        found = raw.layouts(spark, paths).collect()
        assert sorted(len(r.paths) for r in found) == [n // 2, n - n // 2]
    # above 32 paths Spark lists those of a scan in a job too
    assert counts[1] == counts[2] <= counts[0] + 6


def test_headers_come_from_the_first_part_of_a_file(spark, tmp_path, monkeypatch):
    """Parts of a file that do not begin it yield nothing, and all lines are read later."""
    path = tmp_path / "EIA930_BALANCE_2000_Jan_Jun.csv"
    path.write_text(",".join(HEADER) + "\n" + "".join(f"01/01/2000 1:00:00 AM,A{i},1,2,3,4\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert [r.header for r in raw.layouts(spark, [str(path)]).collect()] == [",".join(HEADER)]
        assert raw.read_raw(spark, str(tmp_path)).count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_without_lines(spark, tmp_path):
    (tmp_path / "EIA930_BALANCE_2000_Jan_Jun.csv").write_text("\n \n")
    assert raw.read_raw(spark, str(tmp_path)).where("ba IS NOT NULL").count() == 0
