"""Raw half-yearly CSV files: what should be there, what is there, and reading them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions import schema as S
from hourloom.operators.cleaning import normalise_columns


def file_name(year: Column, half: Column) -> Column:
    return F.format_string(S.RAW_FILE_NAME, year.cast("int"), half)


def half_of(ts: Column) -> Column:
    """Name of the half-year a time falls into."""
    return F.when(F.month(ts) <= 6, F.lit(S.HALF_YEARS[0])).otherwise(F.lit(S.HALF_YEARS[1]))


def expected_files(years: DataFrame) -> DataFrame:
    """``(year, half, file_name)``: two files for every year from ``first`` to ``last`` of ``years``."""
    each = years.select(F.explode(F.sequence("first", "last")).alias("year"))
    halves = each.select("year", F.explode(F.array(*map(F.lit, S.HALF_YEARS))).alias("half"))
    return halves.select("year", "half", file_name(F.col("year"), F.col("half")).alias("file_name"))


def manifest(spark: SparkSession, first_year: int = 2019, last_year: int = 2024) -> DataFrame:
    return expected_files(spark.range(1).select(F.lit(first_year).alias("first"), F.lit(last_year).alias("last")))


def audit_files(expected: DataFrame, present: DataFrame, min_bytes: int = S.MIN_VALID_BYTES) -> DataFrame:
    """Expected files with ``bytes`` and ``status``: ok, tiny (an error page) or missing."""
    size = F.col("bytes")
    status = F.when(size.isNull(), "missing").when(size < min_bytes, "tiny").otherwise("ok")
    return expected.join(present, "file_name", "left").select("year", "half", "file_name", "bytes", status.alias("status"))


def coverage_audit(
    spark: SparkSession, directory: str, first_year: int = 2019, last_year: int = 2024, min_bytes: int = S.MIN_VALID_BYTES
) -> DataFrame:
    """Audit of a directory; only names and sizes are listed, no file is opened.

    Raw files of other years are listed too, as ``unexpected``, with neither year nor half.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", S.RAW_FILE_GLOB).load(directory)
    present = listed.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.col("length").alias("bytes")
    )
    expected = manifest(spark, first_year, last_year)
    others = present.join(expected, "file_name", "left_anti").withColumn("status", F.lit("unexpected"))
    return audit_files(expected, present, min_bytes).unionByName(others, allowMissingColumns=True)


def audit_totals(audit: DataFrame) -> DataFrame:
    return audit.groupBy("status").agg(
        F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0).cast("long")).alias("bytes")
    )


def list_raw_files(spark: SparkSession, directory: str, pattern: str = S.RAW_FILE_GLOB) -> list[str]:
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return [row.path for row in listed.select("path").orderBy("path").toLocalIterator()]


def _csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("header", True).csv(paths)


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line with text of a part of a file, if the part begins the file; what follows is not read."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if batch.column("start")[0].as_py():
            return
        for i, line in enumerate(batch.column("value").to_pylist()):
            if line.strip():
                yield batch.slice(i, 1).select(["path", "value"])
                return


def layouts(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """``(header, paths)``: the files by their first line, in one scan whatever their number; files without a line are left out.

    Every part of a file is a task of its own, which stops after its first lines, so the files themselves are not read. That needs a
    setting of the scan, made in a session beside the given one.
    """
    beside = spark.newSession()
    beside.conf.set("spark.sql.files.openCostInBytes", beside.conf.get("spark.sql.files.maxPartitionBytes"))
    lines = beside.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )
    headers = lines.mapInArrow(_first_line, "path string, value string")
    return headers.groupBy(F.col("value").alias("header")).agg(F.sort_array(F.collect_list("path")).alias("paths"))


def read_raw_files(spark: SparkSession, paths: Iterable[str]) -> list[DataFrame]:
    """One frame of canonical text columns per distinct header, with the ``source_file``.

    A CSV reader given files with different headers applies one header to all of them.  So
    headers are read first, all in one job, and files with the same header share one scan; plan and jobs
    grow with the number of layouts and not with the number of files.
    """
    paths = list(paths)
    if not paths:
        raise FileNotFoundError("no raw files to read")
    groups = [[unquote(path) for path in row["paths"]] for row in layouts(spark, paths).orderBy("header").toLocalIterator()]
    frames = []
    for group in groups or [paths]:
        named = _csv(spark, group).withColumn("source_file", F.col("_metadata.file_name"))
        frames.append(normalise_columns(named))
    return frames


def union_frames(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_raw(spark: SparkSession, directory: str) -> DataFrame:
    return union_frames(read_raw_files(spark, list_raw_files(spark, directory)))


def distinct_entities(frames: Iterable[DataFrame]) -> DataFrame:
    return union_frames(f.select("ba") for f in frames).dropna().distinct()


def schema_report(df: DataFrame) -> DataFrame:
    """``(pos, name, type, filled)``: columns in order, and how many rows have a value."""
    columns = [
        F.struct(
            F.lit(i).alias("pos"),
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.count("`" + field.name.replace("`", "``") + "`").alias("filled"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*columns).alias("columns")).select(F.inline("columns"))
