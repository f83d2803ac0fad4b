"""Writers: cleaned days, profiles, correlations, test logs, fitted pipelines, run logs."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, run_name string, kind string, key string, value string, ts timestamp"


def overwrite_days(df: DataFrame, path: str, day: str = "date", rebalance: bool = False) -> None:
    """One folder per day (or per input file key); only the folders present in ``df`` are replaced.

    ``rebalance`` shuffles rows by day into evenly sized files first: a hot day is split over tasks and
    small days share none, so there are few files per folder. Leave it off when the input is already
    laid out by day.
    """
    rows = df.hint("rebalance", day) if rebalance else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def write_new(df: DataFrame, path: str) -> None:
    """Parquet; an existing target is an error."""
    df.write.mode("errorifexists").parquet(path)


def write_if_absent(df: DataFrame, path: str) -> None:
    """Parquet; an existing target stays as it is."""
    df.write.mode("ignore").parquet(path)


def write_profile(table: DataFrame, path: str, day: str = "date") -> None:
    """Profile report: JSON, one folder per day."""
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).json(path)


def write_correlation(table: DataFrame, path: str, day: str = "date") -> None:
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).json(path)


def append_test_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_rows(
    spark: SparkSession,
    run_id: str,
    run_name: str,
    metrics: dict[str, float] | None = None,
    params: dict | None = None,
    texts: dict[str, str] | None = None,
    ts: dt.datetime | None = None,
) -> DataFrame:
    """Long rows of one run: its metrics, parameters and notes."""
    at = ts or dt.datetime.now()
    rows = [
        (run_id, run_name, kind, key, str(value), at)
        for kind, group in (("metric", metrics), ("param", params), ("text", texts))
        for key, value in (group or {}).items()
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def append_runs(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("append").parquet(path)


def metric_rows(table: DataFrame, run_name: str, metrics: list[str], run_id: str = "model") -> DataFrame:
    """Metric table (one row per run) to run-log rows, without collecting it."""
    return table.select(F.col(run_id).alias("run_id"), *metrics).unpivot(["run_id"], metrics, "key", "value").select(
        "run_id",
        F.lit(run_name).alias("run_name"),
        F.lit("metric").alias("kind"),
        "key",
        F.col("value").cast("string").alias("value"),
        F.current_timestamp().alias("ts"),
    )
