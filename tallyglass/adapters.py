"""Domain tables derived from the generic ``events`` table (deterministic, row-local)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.functions.hashing import hash32

EPOCH = "2024-01-01"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions_from_events(events: DataFrame, timed: bool = False) -> DataFrame:
    """Raw transactions with dirt; keys stay 64-bit.

    Amounts are null or negative, terminals zero, times, customers and labels null, and some rows are null as a whole.
    ``timed`` says that ``events`` holds none of those without a time, so that time filters reach the scan.
    """
    time = "ts" if timed else "case when event_id % 83 = 11 then null else ts end"
    rows = events.selectExpr(
        "event_id",
        "event_id + 1 as transaction_id",
        f"{time} as tx_datetime",
        "case when event_id % 89 = 13 then null else user_id end as customer_id",
        "event_id % 97 as terminal_id",
        "case when event_id % 50 = 7 then null when event_id % 41 = 3 then -value else value end"
        " as tx_amount",
        f"datediff(cast(ts as date), date'{EPOCH}') * 86400L + hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
        " as tx_time_seconds",
        f"datediff(cast(ts as date), date'{EPOCH}') as tx_time_days",
        "case when event_id % 79 = 17 then null when value > 150 then 1"
        " when event_type = 'error' and event_id % 13 = 0 then 1 else 0 end as tx_fraud",
        "case when value > 150 then 1 when event_type = 'error' and event_id % 13 = 0 then 2"
        " else 0 end as tx_fraud_scenario",
    )
    columns = [c for c in rows.columns if c != "event_id"]
    if timed:
        return rows.select(*columns)
    return rows.select(*[F.when(F.col("event_id") % 101 != 19, F.col(c)).alias(c) for c in columns])


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(read_table(spark, sf_dir, "events"))


def timed_transactions(events: DataFrame) -> DataFrame:
    """The transactions that have a time; filters on it reach the scan of ``events``."""
    return transactions_from_events(events.filter((F.col("event_id") % 83 != 11) & (F.col("event_id") % 101 != 19)), True)


def driver_stats_from_events(events: DataFrame) -> DataFrame:
    """Per user and day; the event time is the following midnight, the row is created an hour later."""
    return (
        events.groupBy(F.col("user_id").alias("driver_id"), F.to_date("ts").alias("day"))
        .agg(
            F.avg((F.col("event_type") == "purchase").cast("double")).alias("conv_rate"),
            (1 - F.avg((F.col("event_type") == "error").cast("double"))).alias("acc_rate"),
            F.count(F.lit(1)).alias("avg_daily_trips"),
        )
        .select(
            "driver_id",
            F.expr("cast(day as timestamp_ntz) + interval 1 day").alias("event_timestamp"),
            F.expr("cast(day as timestamp_ntz) + interval 25 hours").alias("created"),
            "conv_rate",
            "acc_rate",
            "avg_daily_trips",
        )
    )


def driver_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_stats_from_events(read_table(spark, sf_dir, "events"))


def feature_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical request rows: sign-ups, with per-call coefficients derived from the event."""
    return (
        read_table(spark, sf_dir, "events")
        .filter("event_type = 'signup'")
        .selectExpr(
            "event_id",
            "user_id as driver_id",
            "ts as event_timestamp",
            "cast(event_id % 7 as double) / 2 as conv_rate_coef",
            "cast(event_id % 5 as double) / 4 as acc_rate_coef",
        )
    )


def predictions_from_events(events: DataFrame) -> DataFrame:
    """Scores of two models on the same rows, long form (model, key, label, weight, score, prediction)."""
    key = F.col("event_id").cast("string")
    label = F.expr(
        "case when value > 150 then 1 when event_type = 'error' and event_id % 13 = 0 then 1 else 0 end"
    )
    noise = hash32(F.concat(F.lit("cand-"), key)) / F.lit(4294967296.0)
    base = events.select(
        F.col("event_id").alias("key"),
        F.col("ts").alias("ts"),
        label.alias("label"),
        F.col("value").alias("amount"),
        (F.col("value") / F.lit(500.0)).alias("baseline"),
        noise.alias("noise"),
    ).withColumn(
        "candidate",
        0.6 * F.col("baseline")
        + 0.4 * F.when(F.col("label") == 1, F.least(F.lit(1.0), F.col("noise") + 0.3)).otherwise(F.col("noise")),
    )
    cutoffs = F.array(
        F.struct(F.lit("baseline").alias("model"), F.col("baseline").alias("score"), F.lit(0.2).alias("cut")),
        F.struct(F.lit("candidate").alias("model"), F.col("candidate").alias("score"), F.lit(0.4).alias("cut")),
    )
    return base.select("key", "ts", "label", "amount", F.explode(cutoffs).alias("m")).select(
        F.col("m.model").alias("model"),
        "key",
        "ts",
        "label",
        F.when(F.col("label") == 1, 10.0).otherwise(1.0).alias("weight"),
        F.col("m.score").alias("score"),
        (F.col("m.score") >= F.col("m.cut")).cast("double").alias("prediction"),
        "amount",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_from_events(read_table(spark, sf_dir, "events"))
