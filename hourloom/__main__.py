"""``python -m hourloom``: coverage of the raw files, the feature table, and the models."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from hourloom.plans import anomaly, features, forecast, incremental, severity
from hourloom.session import configure
from hourloom.sources.raw import audit_totals, coverage_audit
from hourloom.sources.tables import load


def _train(spark: SparkSession, chosen: argparse.Namespace) -> None:
    table, which, model_dir = load(spark, chosen.features), chosen.which, chosen.models
    if which in ("all", "forecast"):
        settings = forecast.ForecastSettings(split=chosen.split, stop_early=chosen.stop_early)
        models, metrics, losses = forecast.train_with_losses(table, settings=settings)
        forecast.save_forecasters(models, metrics, model_dir, losses)
        forecast.load_metrics(spark, model_dir).show()
    if which in ("all", "anomaly"):
        model, scales, scores, loss = anomaly.train_anomaly(table, anomaly.AnomalySettings(contiguous=chosen.contiguous))
        if model is not None:
            anomaly.save_anomaly(model, scales, scores, model_dir, loss)
            spark.read.parquet(f"{model_dir}/anomaly_loss").show()
            anomaly.load_anomaly(spark, model_dir)[3].show()
    if which in ("all", "severity"):
        settings = severity.SeveritySettings(kind=chosen.kind, exclude_label_source=chosen.exclude_label_source)
        model, inputs, predictions = severity.train_severity(table, settings)
        if model is not None:
            severity.save_severity(model, inputs, predictions, model_dir)
            spark.read.parquet(f"{model_dir}/severity_report").show()


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hourloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    audit = commands.add_parser("audit", help="which raw files are there")
    audit.add_argument("raw")
    audit.add_argument("--first-year", type=int, default=2019)
    audit.add_argument("--last-year", type=int, default=2024)
    build = commands.add_parser("features", help="raw files to panel and feature table")
    build.add_argument("raw")
    build.add_argument("panel")
    build.add_argument("features")
    build.add_argument("--fraction", type=float, default=1.0)
    build.add_argument("--sample", choices=("entities", "rows"), default="entities")
    build.add_argument("--lag-mode", choices=("row", "time"), default="row")
    build.add_argument("--layout", choices=("partitioned", "clustered"), default="partitioned", help="of the feature table; clustered for very many series")
    update = commands.add_parser("update", help="panel and features of the raw files that changed")
    update.add_argument("raw")
    update.add_argument("panel")
    update.add_argument("features")
    update.add_argument("--lag-mode", choices=("row", "time"), default="row")
    train = commands.add_parser("train", help="fit and save models")
    train.add_argument("which", choices=("forecast", "anomaly", "severity", "all"))
    train.add_argument("features")
    train.add_argument("models")
    train.add_argument("--split", choices=("random", "time"), default="random", help="hold-out rows of the forecasters")
    train.add_argument("--stop-early", action="store_true", help="forecasters end at the first round without gain, not after fifty")
    train.add_argument("--contiguous", action="store_true", help="no anomaly sequence steps over a gap")
    train.add_argument("--kind", choices=("softmax", "forest", "boosted"), default="softmax", help="the severity classifier")
    train.add_argument("--exclude-label-source", action="store_true", help="without the inputs that the label is made of")
    chosen = parser.parse_args(arguments)

    spark = configure(SparkSession.builder.appName("hourloom").getOrCreate())
    if chosen.command == "audit":
        found = coverage_audit(spark, chosen.raw, chosen.first_year, chosen.last_year)
        found.orderBy("file_name").show(found.count(), truncate=False)
        audit_totals(found).show()
    elif chosen.command == "features":
        table = features.build_features(spark, chosen.raw, chosen.panel, chosen.features, chosen.fraction, chosen.sample, chosen.lag_mode, chosen.layout)
        table.printSchema()
        table.select("ba", "ts_utc", "solar_mw", "wind_mw", "demand_mw", "mismatch_label").show(3, truncate=False)
    elif chosen.command == "update":
        incremental.update_features(spark, chosen.raw, chosen.panel, chosen.features, chosen.lag_mode).orderBy("file_name").show(truncate=False)
    else:
        _train(spark, chosen)


if __name__ == "__main__":
    main()
