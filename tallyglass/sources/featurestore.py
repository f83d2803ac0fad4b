"""Materialised feature tables: an append-only history and a latest-row table merged on read.

The latest-row table is a folder per batch. A batch folder is replaced as a whole when the batch is
retried, so a repeated micro-batch changes nothing. Readers take the newest row per key over all
folders; ``compact`` folds them into one when they have become many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.operators.asof import latest_per_key
from tallyglass.sources import sinks


def derive_if_absent(stats: DataFrame, derive, path: str) -> None:
    """Write the derived source only when it is not there yet."""
    sinks.write_if_absent(derive(stats), path)


def append_history(rows: DataFrame, path: str, batch: int) -> None:
    """History rows of one batch; a retried batch replaces its own folder."""
    _write_batch(rows, path, batch)


def upsert_latest(
    rows: DataFrame, path: str, batch: int, keys: list[str], timestamp: str = "event_timestamp", created: str | None = "created"
) -> None:
    """Newest row per key of one batch, clustered by key so that lookups skip row groups."""
    newest = latest_per_key(rows, keys, timestamp, created)
    _write_batch(newest.sortWithinPartitions(*keys), path, batch)


def _write_batch(rows: DataFrame, path: str, batch: int) -> None:
    rows.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def read_latest(
    spark: SparkSession, path: str, keys: list[str], timestamp: str = "event_timestamp", created: str | None = "created"
) -> DataFrame:
    return latest_per_key(spark.read.parquet(path).drop("batch"), keys, timestamp, created)


def materialize_latest(
    spark: SparkSession, rows: DataFrame, path: str, batch: int, keys: list[str], timestamp: str = "event_timestamp",
    created: str | None = "created",
) -> DataFrame:
    """Batch load of a view's newest rows, and the table as readers see it."""
    upsert_latest(rows, path, batch, keys, timestamp, created)
    return read_latest(spark, path, keys, timestamp, created)


def compact(
    spark: SparkSession, path: str, target: str, keys: list[str], timestamp: str = "event_timestamp", created: str | None = "created"
) -> None:
    """Fold all batches into a fresh table at ``target``; the caller then points readers there."""
    upsert_latest(spark.read.parquet(path).drop("batch"), target, 0, keys, timestamp, created)
