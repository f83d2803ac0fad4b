"""The most frequent values, exactly, without counting every distinct value.

Each task keeps at most ``capacity`` counters per group and column (Misra and Gries 1982, in the mergeable form of
Agarwal et al. 2013): when there are more, the next largest count is taken off all of them, and what was taken off is
the summary's error. A value's true count lies between its counter and counter plus error, also after adding up the
tasks' summaries; a value without a counter occurs at most ``error`` times. So three cases remain, per group and column:

* no error: the counters are the counts;
* the k-th largest counter exceeds the error: no value without counter can be among the k; a second pass counts the
  values whose upper bound reaches the k-th counter, and only those;
* otherwise (flat columns, such as keys): the values are counted in full.

Only counters travel between the passes, at most ``capacity`` per task, group and column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.workspace import checked_broadcast, materialize

CAPACITY = 1000
TASK_COUNTERS = 2_000_000  # counters a task holds before it hands over what it has


def reduce_counters(counters: pd.Series, capacity: int) -> tuple[pd.Series, int]:
    """At most ``capacity`` counters, and what was taken off each."""
    if len(counters) <= capacity:
        return counters, 0
    off = int(np.partition(counters.to_numpy(), len(counters) - capacity - 1)[len(counters) - capacity - 1])
    left = counters[counters > off] - off
    return left, off


def summaries(df: DataFrame, columns: list[str], by: list[str], capacity: int = CAPACITY) -> DataFrame:
    """(by, column, value, low, error): the tasks' counters; a row with a null value carries an error."""
    texts = df.select(*by, *[F.col(c).cast("string").alias(f"_v{i}") for i, c in enumerate(columns)])
    layout = T.StructType([df.schema[c] for c in by]).simpleString()[len("struct<") : -1]
    schema = f"{layout}{', ' if by else ''}code int, value string, low bigint, error bigint"
    names = [*by, "code", "value", "low", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple[pd.Series, int]] = {}
        size = 0
        for batch in batches:
            for key, part in batch.groupby(by, dropna=False, sort=False) if by else [((), batch)]:
                for code in range(len(columns)):
                    found = part[f"_v{code}"].value_counts()
                    before, error = held.get((key, code), (None, 0))
                    both = found if before is None else before.add(found, fill_value=0).astype(np.int64)
                    left, off = reduce_counters(both, capacity)
                    size += len(left) - (0 if before is None else len(before))
                    held[key, code] = (left, error + off)
            if size > TASK_COUNTERS:
                yield from hand_over(held)
                held, size = {}, 0
        yield from hand_over(held)

    def hand_over(held: dict) -> Iterator[pd.DataFrame]:
        for (key, code), (left, error) in held.items():
            out = pd.DataFrame({"value": [*left.index, None], "low": [*left.to_numpy(), 0], "error": [0] * len(left) + [error]})
            for name, value in zip(by, key):
                out[name] = pd.Series([value] * len(out), dtype=object)
            yield out.assign(code=code)[names]

    return texts.mapInPandas(run, schema)


def frequent_values(
    df: DataFrame, columns: list[str], k: int = 5, by: list[str] | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """The ``k`` most frequent values of each column, as text, with exact counts; ties go to the smaller text.

    Nulls are no values. Rows: (by, column, value, count, rank).
    """
    by = by or []
    pair = [*by, "code"]
    counters = materialize(summaries(df, columns, by, capacity), "counters")
    lows = counters.filter("value is not null").groupBy(*pair, "value").agg(F.sum("low").alias("low"))
    errors = counters.groupBy(*pair).agg(F.sum("error").alias("error"))
    order = Window.partitionBy(*pair).orderBy(F.desc("low"))
    kth = lows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    kth = kth.groupBy(*pair).agg(F.when(F.count(F.lit(1)) == k, F.min("low")).alias("kth"))
    joined = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in pair]
    state = errors.alias("l").join(kth.alias("r"), joined, "left").select(*[f"l.{c}" for c in pair], "error", "kth")
    way = F.when(F.col("error") == 0, "counted").when(F.col("kth") > F.col("error"), "again").otherwise("full")
    state = materialize(state.withColumn("way", way), "counter-bounds")
    known = lows.alias("l").join(checked_broadcast(state, "bounds", stored=True).alias("r"), joined)
    known = known.select(*[f"l.{c}" for c in pair], "value", "low", "error", "kth", "way")
    counted = known.filter("way = 'counted'").select(*pair, "value", F.col("low").alias("count"))
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("code"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)]))
    long = df.select(*by, cells.alias("c")).select(*by, "c.*").filter("value is not null")

    def recount(chosen: DataFrame, on: list[str]) -> DataFrame:
        keys = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) if c in by else F.col(f"l.{c}") == F.col(f"r.{c}") for c in on]
        kept = long.alias("l").join(chosen.alias("r"), keys, "left_semi")
        return kept.groupBy(*pair, "value").agg(F.count(F.lit(1)).alias("count"))

    parts = [counted]
    ways = {r["way"] for r in state.select("way").distinct().collect()}
    if "again" in ways:
        survivors = known.filter("way = 'again' and low + error >= kth").select(*pair, "value")
        parts.append(recount(checked_broadcast(survivors, "survivors"), [*pair, "value"]))
    if "full" in ways:
        parts.append(recount(checked_broadcast(state.filter("way = 'full'").select(*pair), "flat-columns"), pair))
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    best = Window.partitionBy(*pair).orderBy(F.desc("count"), "value")
    named = F.array(*[F.lit(c) for c in columns])[F.col("code")].alias("column")
    return counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(*by, named, "value", "count", "rank")
