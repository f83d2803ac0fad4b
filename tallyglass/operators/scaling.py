"""Scaling of a day's features with the statistics of the previous available day, or of the whole table."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, RobustScaler, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.numeric import unless_constant
from tallyglass.operators.profile import calendar
from tallyglass.operators.ranks import quantiles
from tallyglass.workspace import checked_broadcast

SCALERS = ("minmax", "standard", "robust")


def scaler_stats(df: DataFrame, columns: list[str], by: list[str], method: str = "minmax") -> DataFrame:
    """Per group and column the shift and the width of the scaler, as ``{column}_shift/_width``."""
    if method not in SCALERS:
        raise ValueError(f"method must be one of {SCALERS}")
    if method == "robust":
        key = by or ["_all"]
        source = df if by else df.withColumn("_all", F.lit(1))
        q = F.first("q")
        fields = (q[1].alias("shift"), (q[2] - q[0]).alias("width"))
        table = quantiles(source, key, columns, [0.25, 0.5, 0.75]).groupBy(*key).pivot("column", columns).agg(*fields)
        return table if by else table.drop("_all")
    out = []
    for c in columns:
        if method == "minmax":
            shift, width = F.min(c), F.max(c) - F.min(c)
        else:
            shift, width = F.avg(c), unless_constant(F.stddev_samp(c), c)
        out += [shift.cast("double").alias(f"{c}_shift"), width.cast("double").alias(f"{c}_width")]
    return df.groupBy(*by).agg(*out)


def _scaled(columns: list[str], method: str) -> dict:
    """Scaled columns; a constant column gives 0.5 (min-max) or 0.0, as Spark's own scalers do."""
    flat = 0.5 if method == "minmax" else 0.0
    return {
        f"{c}_scaled": F.when(
            F.col(f"{c}_width") > 0, (F.col(c) - F.col(f"{c}_shift")) / F.col(f"{c}_width")
        ).otherwise(F.when(F.col(f"{c}_width").isNotNull() & F.col(c).isNotNull(), F.lit(flat)))
        for c in columns
    }


def scale_by_previous_day(
    df: DataFrame, columns: list[str], day: str = "date", method: str = "minmax", current: DataFrame | None = None
) -> DataFrame:
    """Every day scaled with the day before it; values may leave [0, 1]. The first day has no statistics.

    ``df`` supplies the (cleaned) statistics; ``current`` may be a different, uncleaned frame to scale.
    One aggregation for all days, then a map-side join with one row per day.
    """
    stats = scaler_stats(df, columns, [day], method)
    linked = calendar(df, day).select(F.col("prev_date").alias(day), F.col(day).alias("_day"))
    by_day = linked.join(stats, day).drop(day).withColumnRenamed("_day", day)
    target = df if current is None else current
    joined = target.join(checked_broadcast(by_day, "scaler"), day)
    return joined.withColumns(_scaled(columns, method)).select(*target.columns, *[f"{c}_scaled" for c in columns])


def scale_whole(df: DataFrame, columns: list[str], method: str = "standard") -> DataFrame:
    """Every row scaled with the statistics of the whole table (one row, read as scalar subqueries)."""
    stats = scaler_stats(df, columns, [], method)
    packed = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    names = [n for c in columns for n in (f"{c}_shift", f"{c}_width")]
    wide = df.withColumn("_s", packed).withColumns({n: F.col(f"_s.{n}") for n in names})
    return wide.withColumns(_scaled(columns, method)).select(*df.columns, *[f"{c}_scaled" for c in columns])


def _scaler(method: str, inputs: str, output: str):
    stages = {
        "minmax": MinMaxScaler(inputCol=inputs, outputCol=output),
        "standard": StandardScaler(inputCol=inputs, outputCol=output, withMean=True, withStd=True),
        "robust": RobustScaler(inputCol=inputs, outputCol=output, withCentering=True),
    }
    if method not in stages:
        raise ValueError(f"method must be one of {SCALERS}")
    return stages[method]


def fit_scaler(reference: DataFrame, columns: list[str], method: str = "minmax") -> PipelineModel:
    """A saved-and-reloaded form of the same scaling: assembler (invalid rows skipped) and scaler."""
    assembler = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip")
    return Pipeline(stages=[assembler, _scaler(method, "features", "scaled_features")]).fit(reference)


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows an assembler keeps with ``handleInvalid='skip'``: no null or NaN among the inputs."""
    valid = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns]
    return df.filter(reduce(lambda a, b: a & b, valid))
