"""Cleaning rules for raw transactions, day slices, outlier fences, pseudonyms."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.hashing import pseudonym
from tallyglass.functions.numeric import ratio_or
from tallyglass.operators.ranks import quantiles
from tallyglass.schema import POSITIVE_COLUMNS, TIME_COLUMN
from tallyglass.workspace import checked_broadcast


def all_positive(columns: list[str]) -> Column:
    """Every column is above zero; a null fails."""
    return reduce(lambda a, b: a & b, [F.col(c) > 0 for c in columns])


def clean(df: DataFrame, positive: list[str] | None = None) -> DataFrame:
    """Drop all-null rows, rows that break the positive rule, then rows with any null. One filter."""
    return df.dropna(how="all").filter(all_positive(positive or POSITIVE_COLUMNS)).dropna(how="any")


def reject_counts(df: DataFrame, positive: list[str] | None = None) -> DataFrame:
    """How many rows each rule removes, in rule order, from one pass."""
    rule = F.coalesce(all_positive(positive or POSITIVE_COLUMNS), F.lit(False))
    blank = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in df.columns])
    holes = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(blank).alias("all_null"),
        F.count_if(~blank & ~rule).alias("not_positive"),
        F.count_if(~blank & rule & holes).alias("some_null"),
        F.count_if(rule & ~holes).alias("clean"),
    )


def with_day(df: DataFrame, time_column: str = TIME_COLUMN, name: str = "date") -> DataFrame:
    return df.withColumn(name, F.to_date(time_column))


def days(df: DataFrame, time_column: str = TIME_COLUMN) -> DataFrame:
    """Distinct days in order, nulls removed."""
    return (
        df.select(F.to_date(time_column).alias("date")).filter("date is not null").distinct().orderBy("date")
    )


def day_slice(df: DataFrame, day: str | dt.date, time_column: str = TIME_COLUMN) -> DataFrame:
    """Rows of one day. Written as a time range so that the filter reaches the file scan."""
    start = dt.date.fromisoformat(str(day))
    stamp = df.schema[time_column].dataType
    low, high = (F.lit(str(d)).cast(stamp) for d in (start, start + dt.timedelta(days=1)))
    return df.filter((F.col(time_column) >= low) & (F.col(time_column) < high))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls per column in long form, from one aggregate over all columns."""
    names = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return wide.unpivot([], names, "column", "null_count")


def fill_numeric_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, subset=columns)


def iqr_fences(df: DataFrame, columns: list[str], day: str = "date", k: float = 1.5) -> DataFrame:
    """Lower and upper fence per day and column: quartiles minus / plus ``k`` interquartile ranges."""
    table = quantiles(df.filter(F.col(day).isNotNull()), [day], columns, [0.25, 0.75])
    spread = (F.col("q")[1] - F.col("q")[0]) * F.lit(float(k))
    return table.select(day, "column", (F.col("q")[0] - spread).alias("low"), (F.col("q")[1] + spread).alias("high"))


def drop_outliers(df: DataFrame, columns: list[str], day: str = "date", k: float = 1.5) -> DataFrame:
    """Keep rows whose every listed column lies inside its day's fences; a null column passes."""
    fences = iqr_fences(df, columns, day, k)
    wide = (
        fences.groupBy(day)
        .pivot("column", columns)
        .agg(F.first("low").alias("low"), F.first("high").alias("high"))
    )
    inside = reduce(
        lambda a, b: a & b,
        [F.col(c).isNull() | F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high")) for c in columns],
    )
    joined = df.join(checked_broadcast(wide, "fences"), day)
    return joined.filter(inside).select(df.columns)


def pseudonymise(df: DataFrame, columns: list[str], salt: str) -> DataFrame:
    return df.withColumns({c: pseudonym(F.col(c), salt) for c in columns})


def reject_share(df: DataFrame) -> DataFrame:
    counts = reject_counts(df)
    return counts.withColumn("clean_share", ratio_or(F.col("clean"), F.col("total")))
