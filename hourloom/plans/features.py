"""Raw files to feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourloom.operators.cleaning import clean_panel, reject_counts
from hourloom.operators.sampling import sample_entities, sample_rows
from hourloom.operators.windows import feature_table
from hourloom.session import configure
from hourloom.sources.raw import read_raw
from hourloom.sources.tables import load, write_layout, write_partitioned


def sampled(panel: DataFrame, fraction: float, mode: str = "entities") -> DataFrame:
    """``entities`` keeps whole series; ``rows`` picks single rows, which breaks hourly steps."""
    if fraction >= 1.0:
        return panel
    if mode == "entities":
        return sample_entities(panel, fraction)
    if mode == "rows":
        return sample_rows(panel, fraction)
    raise ValueError(f"mode must be 'entities' or 'rows', got {mode!r}")


def build_features(
    spark: SparkSession,
    raw_dir: str,
    panel_path: str,
    feature_path: str,
    fraction: float = 1.0,
    mode: str = "entities",
    lag_mode: str = "row",
    layout: str = "partitioned",
) -> DataFrame:
    """Clean the raw files into a panel table, then compute the feature table from it.

    The panel is stored first: text is parsed and deduplicated once, and the window stage
    reads only the columns it needs.  ``layout`` is that of the feature table.  How many texts could not be read goes to ``panel_path`` + ``-rejects``.
    """
    configure(spark)
    text = read_raw(spark, raw_dir)
    reject_counts(text).write.mode("overwrite").parquet(f"{panel_path}-rejects")
    write_partitioned(clean_panel(text), panel_path)
    write_layout(feature_table(sampled(load(spark, panel_path), fraction, mode), lag_mode), feature_path, layout)
    return load(spark, feature_path)
