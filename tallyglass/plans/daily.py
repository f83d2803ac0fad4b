"""The daily jobs: clean the next file; profile, compare with the day before, scale all days at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.operators import changepoint, cleaning, drift, profile, scaling
from tallyglass.schema import NUMERIC_COLUMNS, TRANSACTION_SCHEMA
from tallyglass.sources import backlog, sinks, transactions
from tallyglass.workspace import materialize


@dataclass(frozen=True)
class DailyReport:
    cleaned: DataFrame
    profile: DataFrame
    correlation: DataFrame
    comparison: DataFrame
    test_log: DataFrame
    drift: DataFrame
    change_points: DataFrame | None
    scaled: DataFrame


def analyse(
    rows: DataFrame,
    columns: list[str] | None = None,
    with_change_points: bool = False,
    remove_outliers: bool = False,
    scaler: str = "minmax",
) -> DailyReport:
    """Reports on raw rows, scaling on cleaned rows. Rows without a time belong to no day."""
    columns = columns or NUMERIC_COLUMNS
    raw = cleaning.with_day(rows.dropna(how="all")).filter("date is not null")
    cleaned = cleaning.clean(raw)
    if remove_outliers:
        cleaned = cleaning.drop_outliers(cleaned, ["tx_amount"])
    cleaned = materialize(cleaned, "cleaned")
    comparison = materialize(drift.compare_days(raw, columns), "comparison")
    return DailyReport(
        cleaned=cleaned,
        profile=profile.profile(raw, ["date"], columns),
        correlation=profile.correlation(raw, ["date"], columns),
        comparison=comparison,
        test_log=drift.test_log(comparison),
        drift=drift.drifted_columns(comparison),
        change_points=changepoint.change_points(raw, columns) if with_change_points else None,
        scaled=scaling.scale_by_previous_day(cleaned, columns, "date", scaler),
    )


def write_report(report: DailyReport, root: str) -> None:
    """One folder per table, one sub-folder per day."""
    sinks.overwrite_days(report.cleaned, f"{root}/cleaned", rebalance=True)
    sinks.overwrite_days(report.scaled, f"{root}/scaled", rebalance=True)
    sinks.write_profile(report.profile, f"{root}/profile")
    sinks.write_correlation(report.correlation, f"{root}/correlation")
    sinks.overwrite_days(report.test_log, f"{root}/tests")
    sinks.overwrite_days(report.drift, f"{root}/drift")
    if report.change_points is not None:
        sinks.overwrite_days(report.change_points, f"{root}/change_points")


def clean_next(
    spark: SparkSession, raw: str, output: str, schema: T.StructType = TRANSACTION_SCHEMA, backfill: bool = False
) -> str | None:
    """Clean the next raw file into its own folder; its key, or None when nothing is left.

    A file of which every row is rejected leaves no data and still counts as processed. The high-water mark
    is the last processed key. ``backfill`` takes the first file without output
    instead, so gaps left by earlier runs are filled.
    """
    inputs = transactions.list_files(spark, raw)
    done = transactions.processed_keys(spark, output)
    waiting = backlog.unprocessed(inputs, done) if backfill else backlog.next_unprocessed(inputs, done)
    following = waiting.orderBy("key").first()
    if following is None:
        return None
    path = inputs.filter(F.col("key") == following.key).first().path
    rows = transactions.read_with_file_key(spark, path, schema)
    sinks.overwrite_days(cleaning.clean(rows), output, transactions.FILE_KEY)
    transactions.mark_processed(spark, output, following.key)
    return following.key
