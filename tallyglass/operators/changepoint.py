"""Change points of a daily series: optimal segmentation with a penalty per segment.

Rows are first averaged into at most ``max_points`` time slots per day, so a group handed to one
Python call is small by construction however many rows the day has.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.operators.drift import values_long

# Default cost, penalty, point limit, shortest segment and candidate spacing.
COSTS = ("l1", "l2", "rbf")
PENALTY = 3.0
MAX_POINTS = 1000
MIN_SIZE = 2
JUMP = 5
DAY_SECONDS = 86400


def slot_means(df: DataFrame, columns: list[str], time: str, day: str, max_points: int = MAX_POINTS) -> DataFrame:
    """Mean per day, column and time slot; a day has at most ``max_points`` slots."""
    seconds = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    slot = F.floor(seconds * max_points / DAY_SECONDS).cast("int")
    source = df.filter(F.col(day).isNotNull() & F.col(time).isNotNull()).withColumn("slot", slot)
    long = values_long(source, columns, [day, "slot"])
    return long.groupBy(day, "feature", "slot").agg(F.avg("value").alias("value"))


def change_points(
    df: DataFrame,
    columns: list[str],
    cost: str = "rbf",
    penalty: float = PENALTY,
    time: str = "tx_datetime",
    day: str = "date",
    max_points: int = MAX_POINTS,
    jump: int = JUMP,
) -> DataFrame:
    """(day, feature, position, second_of_day) of each inner segment start; days run in parallel.

    A slot is ``86400 / max_points`` seconds wide (86.4 by default) and every ``jump``-th slot may start a
    segment; ``jump=1`` tries all of them.
    """
    if cost not in COSTS:
        raise ValueError(f"cost must be one of {COSTS}")
    means = slot_means(df, columns, time, day, max_points)

    def segment(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot")
        breaks = segment_starts(rows["value"].to_numpy(), cost, penalty, jump)
        slots = rows["slot"].to_numpy()[breaks] if breaks else np.array([], dtype=int)
        return pd.DataFrame(
            {
                day: pd.Series([key[0]] * len(breaks), dtype="object"),
                "feature": pd.Series([key[1]] * len(breaks), dtype="object"),
                "position": pd.Series(breaks, dtype="int64"),
                "second_of_day": pd.Series([math.ceil(s * DAY_SECONDS / max_points) for s in slots], dtype="int64"),
            }
        )

    schema = f"{day} date, feature string, position bigint, second_of_day bigint"
    return means.groupBy(day, "feature").applyInPandas(segment, schema)


def _segment_cost(x: np.ndarray, cost: str):
    """Cost of x[a:b] as a function, prepared so that l2 and rbf need constant time per call."""
    if cost == "l1":
        return lambda a, b: float(np.abs(x[a:b] - np.median(x[a:b])).sum())
    if cost == "l2":
        s, ss = np.concatenate([[0.0], np.cumsum(x - x.mean())]), np.concatenate([[0.0], np.cumsum((x - x.mean()) ** 2)])
        return lambda a, b: float(ss[b] - ss[a] - (s[b] - s[a]) ** 2 / (b - a))
    squared = (x[:, None] - x[None, :]) ** 2
    upper = squared[np.triu_indices(len(x), 1)]
    middle = float(np.median(upper)) if len(upper) else 0.0
    kernel = np.exp(-np.clip(squared / (middle or 1.0), 1e-2, 1e2))
    np.fill_diagonal(kernel, 1.0)
    total = np.zeros((len(x) + 1, len(x) + 1))
    total[1:, 1:] = kernel.cumsum(0).cumsum(1)
    return lambda a, b: float((b - a) - (total[b, b] - total[a, b] - total[b, a] + total[a, a]) / (b - a))


def segment_starts(values: np.ndarray, cost: str = "rbf", penalty: float = PENALTY, jump: int = JUMP) -> list[int]:
    """Starts of all segments but the first, by pruned search, exact among every ``jump``-th start (Killick, Fearnhead, Eckley 2012)."""
    x = np.asarray(values, dtype=float)
    n = len(x)
    if n < 2 * MIN_SIZE:
        return []
    cost_of = _segment_cost(x, cost)
    best, previous, open_starts = {0: 0.0}, {}, [0]
    for end in [*range(jump, n, jump), n]:
        if end < MIN_SIZE:
            continue
        options = {s: best[s] + cost_of(s, end) for s in open_starts if end - s >= MIN_SIZE}
        if not options:
            continue
        start = min(options, key=options.get)
        best[end] = options[start] + penalty
        previous[end] = start
        open_starts = [s for s in open_starts if s not in options or options[s] <= best[end]] + [end]
    breaks, at = [], n
    while previous[at] > 0:
        at = previous[at]
        breaks.append(at)
    return breaks[::-1]
