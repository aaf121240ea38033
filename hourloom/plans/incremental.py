"""Panel and features of changed raw files only.

Beside the panel a table tells of every raw file its size, time and the years its rows fall into. An update compares it with the
directory, rebuilds the years that new, replaced or removed files touch, and then the features of these years and of those whose windows
reach into them. Only their partitions are written; the result is that of a full build.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.functions.scalar import parse_timestamp
from hourloom.operators.cleaning import clean_panel
from hourloom.operators.windows import feature_table
from hourloom.plans.features import build_features
from hourloom.session import configure, durable, stored_meanwhile
from hourloom.sources.raw import read_raw_files, union_frames
from hourloom.sources.tables import load

#: Rows back and ahead that a feature reads: lags and leads. A rolling week never reaches beyond the year next to it.
_BACK, _AHEAD = max(S.LAG_HOURS), max(S.LEAD_HOURS)


def listed_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``(file_name, path, bytes, modified)`` of the raw files; none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", S.RAW_FILE_GLOB).load(raw_dir)
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "path", F.col("length").alias("bytes"),
        F.unix_micros("modificationTime").alias("modified"),
    )


def file_changes(present: DataFrame, known: DataFrame) -> DataFrame:
    """``(file_name, path, bytes, modified, years, change)``; change is new, replaced, removed or same."""
    here, before = present.alias("here"), known.alias("before")
    same = (F.col("here.bytes") == F.col("before.bytes")) & (F.col("here.modified") == F.col("before.modified"))
    change = (
        F.when(F.col("before.file_name").isNull(), "new").when(F.col("here.file_name").isNull(), "removed").when(same, "same").otherwise("replaced")
    )
    joined = here.join(before, F.col("here.file_name") == F.col("before.file_name"), "full")
    return joined.select(
        F.coalesce("here.file_name", "before.file_name").alias("file_name"), "here.path", "here.bytes", "here.modified",
        "before.years", change.alias("change"),
    )


def file_years(text: DataFrame) -> DataFrame:
    """``(file_name, years)``: the years of the readable hours of each file."""
    year = F.year(parse_timestamp(F.col("ts_utc")))
    return text.groupBy(F.url_decode("source_file").alias("file_name")).agg(F.sort_array(F.collect_set(year)).alias("years"))


def reached_years(panel: DataFrame, years: list[int], after: int, before: int) -> list[int]:
    """``years`` and those that lie within ``after`` rows behind or ``before`` rows ahead of one of them, in any series.

    Counts by series and year decide: a year is reached if fewer rows than that lie between.
    """
    counts = panel.groupBy("ba", "year").count()
    between = F.when(F.col("year").isin(years), 0).otherwise(F.col("count"))
    order, reached = Window.partitionBy("ba").orderBy("year"), F.lit(False)
    for year in years:
        later = F.sum(F.when(F.col("year") > year, between).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, -1))
        earlier = F.sum(F.when(F.col("year") < year, between).otherwise(0)).over(order.rowsBetween(1, Window.unboundedFollowing))
        reached = (
            reached
            | ((F.col("year") > year) & (F.coalesce(later, F.lit(0)) < after))
            | ((F.col("year") < year) & (F.coalesce(earlier, F.lit(0)) < before))
        )
    found = counts.select("year", reached.alias("reached")).where("reached").select("year").distinct()
    return sorted({*years, *(r["year"] for r in found.collect())})


def replace_years(df: DataFrame, path: str, years: list[int]) -> None:
    """Write the partitions of ``years`` anew; those of series without rows there now go, all others stay as they are."""
    spark = df.sparkSession
    files = load(spark, path).where(F.col("year").isin(years)).select("year", "ba", F.col("_metadata.file_path").alias("file")).distinct()
    with stored_meanwhile(df.where(F.col("year").isin(years)), "replaced") as new, stored_meanwhile(files, "earlier") as old:
        new.hint("rebalance", "year", "ba").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "ba").parquet(path)
        left = new.select("year", F.col("ba").alias("__ba")).distinct()
        gone = old.join(left, (old["year"] == left["year"]) & old["ba"].eqNullSafe(left["__ba"]), "left_anti")
        folders = gone.select(F.regexp_extract("file", "^(.*)/[^/]+$", 1).alias("folder")).distinct()
        for row in folders.toLocalIterator():
            folder = spark._jvm.org.apache.hadoop.fs.Path(unquote(row["folder"]))
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _manifest_path(panel_path: str) -> str:
    return f"{panel_path}-files"


def _write_manifest(files: DataFrame, panel_path: str) -> None:
    told = durable(files.select("file_name", "bytes", "modified", F.coalesce("years", F.array().cast("array<int>")).alias("years")))
    told.coalesce(1).write.mode("overwrite").parquet(_manifest_path(panel_path))


def _text(spark: SparkSession, paths: list[str]) -> DataFrame:
    return union_frames(read_raw_files(spark, paths))


def update_features(spark: SparkSession, raw_dir: str, panel_path: str, feature_path: str, lag_mode: str = "row") -> DataFrame:
    """Bring panel and features up to date with the raw files; ``(file_name, change)`` of all files.

    Without a table of known files all is built. A change of one file reads the files that share a year with it, and
    computes features of that year and of those next to it (further ones only after a gap of more than a year). The counts of unreadable
    texts stay those of the last whole build.
    """
    configure(spark)
    present = durable(listed_files(spark, raw_dir))
    if present.isEmpty():
        raise FileNotFoundError("no raw files to read")
    try:
        known = spark.read.parquet(_manifest_path(panel_path))
    except AnalysisException:
        build_features(spark, raw_dir, panel_path, feature_path, lag_mode=lag_mode)
        years = file_years(_text(spark, [r["path"] for r in present.select("path").toLocalIterator()]))
        _write_manifest(present.join(years, "file_name", "left"), panel_path)
        return present.select("file_name", F.lit("new").alias("change"))
    changes = durable(file_changes(present, known))
    fresh = [r["path"] for r in changes.where("change IN ('new', 'replaced')").select("path").orderBy("path").toLocalIterator()]
    if not fresh and changes.where("change = 'removed'").isEmpty():
        return changes.select("file_name", "change")
    found = file_years(_text(spark, fresh)) if fresh else spark.createDataFrame([], "file_name string, years array<int>")
    now = changes.join(found.withColumnRenamed("years", "found"), "file_name", "left")
    now = durable(now.withColumn("now", F.when(F.col("change") == "same", F.col("years")).otherwise(F.col("found"))))
    either = F.array_union(F.coalesce("years", F.array().cast("array<int>")), F.coalesce("now", F.array().cast("array<int>")))
    touched = sorted(r["year"] for r in now.where("change <> 'same'").select(F.explode(either).alias("year")).where("year IS NOT NULL").distinct().collect())
    if touched:
        holds = F.arrays_overlap("now", F.array(*[F.lit(y) for y in touched]))
        sources = [r["path"] for r in now.where((F.col("change") != "removed") & holds).select("path").orderBy("path").toLocalIterator()]
        panel = clean_panel(_text(spark, sources)) if sources else spark.createDataFrame([], S.PANEL_SCHEMA)
        replace_years(panel, panel_path, touched)
        whole = load(spark, panel_path)
        changed = reached_years(whole, touched, _BACK, _AHEAD)
        read = reached_years(whole, changed, _AHEAD, _BACK)
        replace_years(feature_table(whole.where(F.col("year").isin(read)), lag_mode), feature_path, changed)
    _write_manifest(now.where("change <> 'removed'").drop("years").withColumnRenamed("now", "years"), panel_path)
    return changes.select("file_name", "change")
