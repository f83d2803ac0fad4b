"""Mergeable day states: one small row per day and column from which weeks, months and totals follow.

A state holds counts, mean, squared deviations, extremes, a distinct-count sketch (HyperLogLog) and a quantile sketch
(KLL). States of days are stored once; any longer span is a merge of stored states, which reads no row again.
Merged distinct counts equal those of a sketch over all rows; merged quantiles keep the sketch's rank error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.functions.numeric import as_numeric, numeric_columns, ratio_or
from tallyglass.operators.profile import column_rows
from tallyglass.sources import sinks

# Distinct sketches of 2^14 registers: relative standard error 1.04 / sqrt(2^14), under 1 %.
DISTINCT_LOG2 = 14
# Quantile sketches of this width: rank error under 1 % of the rows, with room.
QUANTILE_WIDTH = 800
RANK_ERROR = 0.01
DISTINCT_ERROR = 0.03
QUARTILES = [0.25, 0.5, 0.75]
STATE_COLUMNS = ["rows", "non_null", "mean", "squares", "min", "max", "distinct", "quantiles"]


def state_aggregates(value: str = "value") -> list[Column]:
    """The aggregates that make a state of a numeric column; nulls count only as rows."""
    v = F.col(value)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count(v).alias("non_null"),
        F.avg(v).alias("mean"),
        (F.var_pop(v) * F.count(v)).alias("squares"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.hll_sketch_agg(F.when(v.isNotNull(), F.xxhash64(v + F.lit(0.0))), F.lit(DISTINCT_LOG2)).alias("distinct"),
        F.kll_sketch_agg_double(v, F.lit(QUANTILE_WIDTH)).alias("quantiles"),
    ]


def day_states(df: DataFrame, columns: list[str] | None = None, day: str = "date") -> DataFrame:
    """(day, column, state): one scan, a shuffle of partial states. Rows without a day are left out."""
    columns = columns or [c for c in numeric_columns(df) if c != day]
    source = as_numeric(df, columns).filter(F.col(day).isNotNull())
    table = column_rows(source, [day], columns).groupBy(day, "code").agg(*state_aggregates())
    names = F.array(*[F.lit(c) for c in columns])
    return table.select(day, names[F.col("code")].alias("column"), *STATE_COLUMNS)


def store(states: DataFrame, path: str, day: str = "date") -> None:
    """Write states, one folder per day; a day that is written again replaces its folder."""
    sinks.overwrite_days(states, path, day)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merge(states: DataFrame, by: list[str]) -> DataFrame:
    """States of wider groups: ``by`` names columns of ``states`` (none for the total of each column)."""
    span = Window.partitionBy(*by, "column")
    mean = ratio_or(F.sum(F.col("mean") * F.col("non_null")).over(span), F.sum("non_null").over(span), None)
    off = F.col("mean") - F.col("_mean")
    merged = states.withColumn("_mean", mean).groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"),
        F.sum("non_null").alias("non_null"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("squares") + F.col("non_null") * off * off).alias("squares"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_WIDTH)).alias("quantiles"),
    )
    return merged.select(*by, "column", *STATE_COLUMNS)


def roll_up(states: DataFrame, period: str, day: str = "date") -> DataFrame:
    """Days to weeks, months, quarters or years, named by their first day; states again, so it can be repeated."""
    if period not in ("week", "month", "quarter", "year"):
        raise ValueError("period must be week, month, quarter or year")
    return merge(states.withColumn(day, F.trunc(day, period)), [day])


def summary(states: DataFrame, fractions: list[float] = QUARTILES) -> DataFrame:
    """What the states say: counts, mean, deviation, extremes, distinct values and quantiles (array ``q``)."""
    rest = [c for c in states.columns if c not in STATE_COLUMNS]
    points = F.array(*[F.lit(f) for f in fractions])
    return states.select(
        *rest,
        "rows",
        "non_null",
        "mean",
        F.when(F.col("non_null") > 0, F.sqrt(F.greatest(F.col("squares"), F.lit(0.0)) / F.col("non_null"))).alias("std"),
        "min",
        "max",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        F.when(F.col("non_null") > 0, F.kll_sketch_get_quantile_double("quantiles", points)).alias("q"),
    )
