"""Splits, samples, and class weights."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions.hashing import TWO_32, hash32
from tallyglass.schema import LABEL
from tallyglass.workspace import checked_broadcast


# Ranks up to this limit are pre-filtered per task by the optimizer (its default threshold).
PRE_LIMIT = 1000


def hash_split(df: DataFrame, key: str, train: float = 0.8, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key hash: stable under repartitioning, retries and re-runs.

    A row with a null key belongs to the test rows.
    """
    if not 0 <= train <= 1:
        raise ValueError("train must be a share")
    chosen = F.coalesce(hash32(F.concat(F.lit(salt), F.col(key).cast("string"))) < F.lit(round(train * TWO_32)), F.lit(False))
    return df.filter(chosen), df.filter(~chosen)


def random_split(df: DataFrame, train: float = 0.8, seed: int = 42) -> list[DataFrame]:
    """Spark's own split; the result depends on the partitioning of ``df``."""
    return df.randomSplit([train, 1 - train], seed=seed)


def hash_fold(key: str, folds: int = 3, salt: str = "fold-") -> Column:
    return (hash32(F.concat(F.lit(salt), F.col(key).cast("string"))) % folds).cast("int")


def hash_sample(df: DataFrame, key: str, n: int, salt: str = "", by: list[str] | None = None) -> DataFrame:
    """``min(n, rows)`` rows without replacement, per group when ``by`` is given, in key-hash order.

    Every task keeps only its own ``n`` smallest before anything is exchanged; for samples above the
    optimizer's own limit for that, each of 256 slices of a group is cut to ``n`` first.
    """
    draw = hash32(F.concat(F.lit(salt), F.col(key).cast("string")))
    if not by:
        return df.orderBy(draw, key).limit(n)
    rows = df.withColumn("_draw", draw)
    if n > PRE_LIMIT:
        slices = Window.partitionBy(*by, F.col("_draw") % 256).orderBy("_draw", key)
        rows = rows.withColumn("_n", F.row_number().over(slices)).filter(F.col("_n") <= n)
    order = Window.partitionBy(*by).orderBy("_draw", key)
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n", "_draw")


def sample_with_replacement(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)


def poisson_cdf(rate: float) -> list[float]:
    """Cumulative probabilities of a Poisson count until a 32-bit draw cannot tell the rest apart."""
    term = total = math.exp(-rate)
    steps, k = [total], 0
    while 1.0 - total > 2.0**-34 and term > 0:
        k += 1
        term *= rate / k
        total += term
        steps.append(total)
    return steps


def poisson_steps(rate: float) -> list[str]:
    """The cumulative steps as 32-bit hexadecimal words: a draw lies above step c when (w + 0.5) / 2^32 > c."""
    words = [math.floor(c * TWO_32 - 0.5) + 1 for c in poisson_cdf(rate)]
    return [f"{w:08x}" for w in words if w < TWO_32]


def poisson_count(word: Column, rate: float) -> Column:
    """Inverse-CDF Poisson count of an 8-digit hexadecimal draw: the number of steps it reaches.

    Fixed-width hexadecimal text sorts like the number, so no draw is ever parsed.
    """
    count = F.lit(0)
    for step in poisson_steps(rate):
        count = count + (word >= F.lit(step)).cast("int")
    return count


def constant_class_weight(label: str = LABEL, positive: float = 10.0) -> Column:
    return F.when(F.col(label) == 1, F.lit(positive)).otherwise(F.lit(1.0))


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight per class: total / (classes * count). Null labels are no class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    # One row per class reaches this window.
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("count").over(everything).cast("double")
    classes = F.count(F.lit(1)).over(everything)
    return counts.select(label, "count", (total / (classes * F.col("count"))).alias("weight"))


def with_balanced_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows with their class weight; a row without a label gets 1.0."""
    weights = class_weights(df, label).select(label, "weight")
    joined = df.join(checked_broadcast(weights, "class-weights"), label, "left")
    return joined.select(*df.columns, F.coalesce("weight", F.lit(1.0)).alias("weight"))
