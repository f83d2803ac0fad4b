"""Small arithmetic helpers that are safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio_or(numerator: Column, denominator: Column, otherwise: float | None = 0.0) -> Column:
    """``numerator / denominator`` as double; ``otherwise`` when the denominator is not positive."""
    value = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, value).otherwise(F.lit(otherwise).cast("double"))


def finite(column: Column) -> Column:
    """NaN becomes null, so that comparisons and aggregates see a missing value."""
    return F.when(F.isnan(column), F.lit(None).cast("double")).otherwise(column)


def unless_constant(spread: Column, column: str) -> Column:
    """An aggregate deviation, exactly 0 for a constant column.

    Merged partial states carry rounding noise, so only equal extremes prove that nothing varies.
    """
    return F.when((F.min(column) == F.max(column)) & spread.isNotNull(), F.lit(0.0)).otherwise(spread)


def percent_change(new: Column, old: Column) -> Column:
    return F.when(old != 0, (new - old) / old * 100.0)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type, and text columns whose metadata carries a true ``numeric`` tag."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType)
        or (isinstance(f.dataType, T.StringType) and f.metadata.get("numeric"))
    ]


def as_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Parse tagged text columns to double; text that is no number becomes null."""
    texts = [f.name for f in df.schema.fields if f.name in columns and isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: F.col(name).try_cast("double") for name in texts}) if texts else df
