"""Streams of transactions and features. All of them restart from their checkpoint folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyglass.functions.numeric import unless_constant
from tallyglass.operators.asof import micros
from tallyglass.operators.cleaning import clean
from tallyglass.operators.daystates import STATE_COLUMNS, state_aggregates
from tallyglass.operators.drift import values_long
from tallyglass.operators.featureviews import Entity, PushSource
from tallyglass.operators.profile import column_rows
from tallyglass.schema import TIME_COLUMN, TRANSACTION_SCHEMA
from tallyglass.sources import featurestore


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "csv", files_per_batch: int | None = 1
) -> DataFrame:
    """New files of a folder or glob as a stream; one file per micro-batch by default."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def start_clean(rows: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Clean every waiting input and stop; the file sink commits each micro-batch exactly once."""
    return (
        clean(rows)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_clean(
    spark: SparkSession, path: str, output: str, checkpoint: str, schema: T.StructType = TRANSACTION_SCHEMA,
    file_format: str = "csv", files_per_batch: int | None = 1,
) -> DataFrame:
    """The daily cleaning job: process what arrived since the last run, return the whole output."""
    stream = stream_files(spark, path, schema, file_format, files_per_batch)
    start_clean(stream, output, checkpoint).awaitTermination()
    return spark.read.schema(schema).parquet(output)


def wall_clock(column: str) -> Column:
    """Event time for watermarks and day windows: the local wall clock, read as UTC.

    Watermarks need a zoned type and day windows start at midnight UTC; this form puts their edges at
    local midnight whatever the session time zone.
    """
    local = T.TimestampNTZType()
    return F.timestamp_micros(micros(F.col(column).cast(local), local))


def without_repeats(rows: DataFrame, keys: list[str], time: str = TIME_COLUMN, delay: str = "1 day") -> DataFrame:
    """Drop repeats that arrive within the watermark; state older than it is forgotten."""
    timed = rows.withColumn("_at", wall_clock(time)).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark(keys).drop("_at")


def daily_profile(rows: DataFrame, columns: list[str], time: str = TIME_COLUMN, delay: str = "1 day") -> DataFrame:
    """Mergeable statistics per day and column; a day is emitted once the watermark has passed its end.

    State is one row per open day and column. Exact distinct counts and quantiles do not merge, so
    distinct values are a sketch here. Rows later than ``delay`` are dropped.
    """
    timed = rows.withColumn("_at", wall_clock(time)).withWatermark("_at", delay)
    long = values_long(timed, columns, ["_at"])
    start = F.floor(F.unix_micros("w.start") / F.lit(86_400_000_000)).cast("int")
    return (
        long.groupBy(F.window("_at", "1 day").alias("w"), "feature")
        .agg(
            F.count("value").alias("rows"),
            F.avg("value").alias("mean"),
            unless_constant(F.stddev_pop("value"), "value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.approx_count_distinct("value").alias("approx_distinct"),
        )
        .select(
            F.date_from_unix_date(start).alias("date"), "feature", "rows", "mean", "std", "min", "max", "approx_distinct"
        )
    )


def daily_states(rows: DataFrame, columns: list[str], time: str = TIME_COLUMN, delay: str = "1 day") -> DataFrame:
    """Mergeable states (``daystates``) per day and column, quantile and distinct sketches included.

    A day is emitted once the watermark has passed its end; until then it is one state row per column.
    """
    timed = rows.withColumn("_at", wall_clock(time)).withWatermark("_at", delay)
    cells = column_rows(timed, ["_at"], columns)
    table = cells.groupBy(F.window("_at", "1 day").alias("w"), "code").agg(*state_aggregates())
    start = F.floor(F.unix_micros("w.start") / F.lit(86_400_000_000)).cast("int")
    names = F.array(*[F.lit(c) for c in columns])
    return table.select(F.date_from_unix_date(start).alias("date"), names[F.col("code")].alias("column"), *STATE_COLUMNS)


def run_to_table(stream: DataFrame, output: str, checkpoint: str, trigger: dict | None = None) -> DataFrame:
    """Drain a stream into Parquet in append mode and read the result."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if trigger:
        drain(query)
    else:
        query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(output)


def push_features(
    stream: DataFrame,
    checkpoint: str,
    keys: list[str],
    history: str | None = None,
    latest: str | None = None,
    timestamp: str = "event_timestamp",
    created: str | None = "created",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write arriving feature rows to the history, to the latest-row table, or to both.

    The micro-batch number names the folder it writes, so a replay overwrites itself. Without a ``trigger`` the
    query takes what is there and stops.
    """

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist() if history and latest else batch
        if history:
            featurestore.append_history(kept, history, number)
        if latest:
            featurestore.upsert_latest(kept, latest, number, keys, timestamp, created)
        if history and latest:
            kept.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def drain(query: StreamingQuery) -> StreamingQuery:
    """Let a running query work off what has arrived, in as many micro-batches as its source makes, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def push_to_source(
    stream: DataFrame, source: PushSource, entity: Entity, checkpoint: str, history: str | None = None, latest: str | None = None
) -> StreamingQuery:
    """Push rows of a declared source: its batch source names the time columns, the entity the keys."""
    batch = source.batch_source
    return push_features(stream, checkpoint, list(entity.join_keys), history, latest, batch.timestamp, batch.created)
