"""Which inputs are still to be processed, from two key tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def file_stem(path: Column) -> Column:
    """File name without folder and extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?$", 1)


def dated_name(day: Column) -> Column:
    """The name of a day's input or output: year, month and day in eight digits."""
    return F.date_format(day, "yyyyMMdd")


def after_high_water_mark(inputs: DataFrame, processed: DataFrame, key: str = "key") -> DataFrame:
    """Inputs later than the last processed key; all of them when nothing is processed."""
    mark = processed.agg(F.max(key)).scalar()
    return inputs.filter(mark.isNull() | (F.col(key) > mark))


def next_unprocessed(inputs: DataFrame, processed: DataFrame, key: str = "key") -> DataFrame:
    """The first input after the high-water mark: one row, or none when everything is done."""
    return after_high_water_mark(inputs, processed, key).select(key).orderBy(key).limit(1)


def unprocessed(inputs: DataFrame, processed: DataFrame, key: str = "key") -> DataFrame:
    """Every input without a processed twin, gaps included (for backfills)."""
    return inputs.join(processed.select(key).distinct(), key, "left_anti").select(key)
