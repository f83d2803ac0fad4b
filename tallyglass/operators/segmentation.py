"""Change points of the whole ordered series: binary segmentation by squared error over prefix sums.

Rows of one time are one cell; cells are never averaged into slots or sampled. Prefix sums of counts and values are
running sums in range buckets, so a group that holds most of the table is spread over tasks. A segment of more than
``TASK_CELLS`` cells is cut by one job per level over the cells of all such segments of all groups: each cell's gain as a
cut follows from its own prefix and the two ends of its segment, and the best cut per segment is an aggregate that
combines map-side. Only one row per open segment comes back; the cells of closed segments drop out.

A smaller segment is a task's: its cells move once, and all levels below it are cut there, however many they are. The
gain is convex in the prefix (rows, sum), so the corners of a frame around a block of cells bound the gains in it, and a
cut reads only the blocks whose bound reaches the best gain.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.operators.drift import values_long
from tallyglass.operators.ranks import SPLIT_ABOVE, running_sums
from tallyglass.workspace import checked_broadcast, materialize

MIN_SIZE = 2
PENALTY = 3.0
GAIN_DIGITS = 6  # gains that agree so far are ties; the earlier cut wins
TASK_CELLS = 2_000_000  # a segment up to this is cut in one task, in about 100 MB
BLOCK = 512


def ordered_series(df: DataFrame, columns: list[str], by: list[str], time: str, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """(by, feature, time, before, sum_before, size, total): standardised values as prefix sums per time.

    Rows without a time or value are left out; so are columns that do not vary within a group.
    """
    group = [*by, "feature"]
    long = materialize(values_long(df.filter(F.col(time).isNotNull()), columns, [*by, time]), "series-values")
    stats = long.groupBy(*group).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count(F.lit(1)).alias("size"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    varied = checked_broadcast(stats.filter((F.col("low") < F.col("high")) & (F.col("std") > 0)).drop("low", "high"), "series-stats")
    scaled = long.join(varied, group).withColumn("x", (F.col("value") - F.col("mean")) / F.col("std"))
    cells = scaled.groupBy(*group, time).agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"))
    summed = running_sums(cells, group, time, {"before": "n", "sum_before": "s"}, split_above)
    return summed.join(varied.select(*group, "size"), group).select(*group, time, "before", "sum_before", "size")


def gain() -> Column:
    """How much the squared error falls when the segment (a, b) is cut ahead of a cell."""
    left, right = F.col("before") - F.col("a"), F.col("b") - F.col("before")
    first, second = F.col("sum_before") - F.col("sum_a"), F.col("sum_b") - F.col("sum_before")
    whole = F.col("sum_b") - F.col("sum_a")
    return first * first / left + second * second / right - whole * whole / (F.col("b") - F.col("a"))


def _rounded(gain: float) -> float:
    """As Spark's ``round``: half up, on the shortest decimal form."""
    return float(Decimal(repr(gain)).quantize(Decimal(1).scaleb(-GAIN_DIGITS), ROUND_HALF_UP)) if np.isfinite(gain) else gain


class Cells:
    """Prefix sums of a segment's cells in order, with a frame around every block: its ends and distances from its chord."""

    def __init__(self, before, sum_before, block: int = BLOCK):
        self.whole, self.x, self.y, self.block = before, before.astype(np.float64), sum_before, block
        n = len(before) // block * block
        self.plain = not np.isfinite(sum_before).all()
        if not n or self.plain:
            self.corners = np.zeros((2, 4, 0))
            return
        x, y = self.x[:n].reshape(-1, block), self.y[:n].reshape(-1, block)
        off = y - (y[:, :1] + (y[:, -1:] - y[:, :1]) * (x - x[:, :1]) / (x[:, -1:] - x[:, :1]))
        low, high = off.min(axis=1), off.max(axis=1)
        ends = [x[:, 0], x[:, 0], x[:, -1], x[:, -1]], [y[:, 0] + low, y[:, 0] + high, y[:, -1] + low, y[:, -1] + high]
        self.corners = np.array(ends)

    def best_cut(self, a: int, b: int, sum_a: float, sum_b: float, least: float, min_size: int) -> tuple[int, float] | None:
        """Place and rounded gain of the largest gain over ``least``, the earlier of ties; a gain that is no number is the largest."""
        i, j = np.searchsorted(self.whole, a + min_size), np.searchsorted(self.whole, b - min_size, "right")
        if i >= j:
            return None

        def gains(x, y):
            first, second, whole = y - sum_a, sum_b - y, sum_b - sum_a
            return first * first / (x - a) + second * second / (b - x) - whole * whole / (b - a)

        size, first, last = self.block, -(-i // self.block), j // self.block
        if self.plain or last - first < 4:
            places, values = np.arange(i, j), gains(self.x[i:j], self.y[i:j])
            if np.isnan(values).any():
                return int(places[np.isnan(values).argmax()]), float("nan")
        else:
            bounds = gains(*self.corners[:, :, first:last]).max(axis=0)
            order, at, take = np.argsort(-bounds), 0, 2
            places = np.concatenate((np.arange(i, first * size), np.arange(last * size, j)))
            values = gains(self.x[places], self.y[places])
            top = max(values.max(initial=-np.inf), least)
            while at < len(order) and bounds[order[at]] >= top - self._slack(top):
                more = ((first + order[at : at + take])[:, None] * size + np.arange(size)).ravel()
                places, values = np.concatenate((places, more)), np.concatenate((values, gains(self.x[more], self.y[more])))
                top, at, take = max(top, values.max()), at + take, take * 2
        top = values.max(initial=-np.inf)
        if top <= least - self._slack(least):
            return None
        near = values >= top - self._slack(top)
        gain, place = max((_rounded(v), -p) for v, p in zip(values[near].tolist(), places[near].tolist()))
        return (-place, gain) if gain > least else None

    @staticmethod
    def _slack(gain: float) -> float:
        """Gains that are further apart do not round to the same."""
        return 2 * 10.0**-GAIN_DIGITS + 1e-12 * abs(gain)


def cuts_within(cells: Cells, a: int, b: int, sum_a: float, sum_b: float, least: float, min_size: int) -> list[tuple[int, int, float]]:
    """(place, levels below the segment's own, gain) of all cuts of a segment."""
    found, open_ = [], [(a, b, sum_a, sum_b, 0)]
    while open_:
        a, b, sum_a, sum_b, depth = open_.pop()
        cut = cells.best_cut(a, b, sum_a, sum_b, least, min_size)
        if cut:
            at, middle = int(cells.whole[cut[0]]), float(cells.y[cut[0]])
            found.append((cut[0], depth, cut[1]))
            open_ += [(a, at, sum_a, middle, depth + 1), (at, b, middle, sum_b, depth + 1)]
    return found


def _cut_in_tasks(cells: DataFrame, segments: DataFrame, group: list[str], time: str, level: int, min_size: int, schema: str) -> DataFrame:
    """All cuts of the given segments, each segment in one task; ``level`` is that of their first cuts."""
    names, ends = [*group, "position", time, "level", "gain"], ["a", "b", "sum_a", "sum_b", "least"]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("before")
        inside = Cells(*(rows[c].to_numpy() for c in ("before", "sum_before")))
        found = cuts_within(inside, *(rows[c][0].as_py() for c in ends), min_size)
        at = rows.take(pa.array([place for place, _, _ in found], pa.int64()))
        levels, gains = pa.array([level + d for _, d, _ in found], pa.int32()), pa.array([g for _, _, g in found], pa.float64())
        return pa.Table.from_arrays([*(at[c] for c in group), at["before"], at[time], levels, gains], names)

    rows = cells.join(segments.drop("cells"), [*group, "a"]).select(*group, time, "before", "sum_before", *ends)
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(rows.repartition(tasks, *group, "a").groupBy(*group, "a").applyInArrow(run, schema), "cuts")


def segment_series(
    series: DataFrame, by: list[str], time: str, penalty: float = PENALTY, min_size: int = MIN_SIZE, task_cells: int = TASK_CELLS
) -> DataFrame:
    """(by, feature, position, time, level, gain): the cuts of ``ordered_series``.

    A segment is cut where the gain is largest, if it exceeds ``penalty`` times the logarithm of the group's rows and
    leaves at least ``min_size`` rows on both sides. ``position`` is the number of rows before the cut.
    """
    group = [*by, "feature"]
    spark = series.sparkSession
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in series.select(*group).schema)
    schema = f"{names}, position bigint, {time} {series.schema[time].dataType.simpleString()}, level int, gain double"
    cells = materialize(series, "series")
    ends = cells.groupBy(*group).agg(F.first("size").alias("b"), F.count(F.lit(1)).alias("cells"))
    # Standardised values add up to 0, but for rounding.
    open_ = ends.withColumns({"a": F.lit(0).cast("bigint"), "sum_a": F.lit(0.0), "sum_b": F.lit(0.0)})
    open_ = open_.withColumn("least", F.lit(penalty) * F.log(F.col("b").cast("double")))
    cells = cells.withColumn("a", F.lit(0).cast("bigint"))
    found, level = [], 0
    while True:
        level += 1
        segments = checked_broadcast(open_.select(*group, "a", "b", "sum_a", "sum_b", "least", "cells"), "segments")
        small, large = segments.filter(F.col("cells") <= task_cells), segments.filter(F.col("cells") > task_cells)
        if not small.isEmpty():
            found.append(_cut_in_tasks(cells, small, group, time, level, min_size, schema))
        if large.isEmpty():
            break
        inside = cells.join(large.drop("cells"), [*group, "a"])
        cut = F.struct(
            F.round(gain(), GAIN_DIGITS).alias("gain"), (-F.col("before")).alias("order"), F.col(time).alias("at"), "before", "sum_before"
        )
        allowed = (F.col("before") - F.col("a") >= min_size) & (F.col("b") - F.col("before") >= min_size)
        best = inside.filter(allowed).groupBy(*group, "a").agg(F.max(cut).alias("c"), *[F.first(c).alias(c) for c in ("b", "sum_a", "sum_b", "least")])
        splits = materialize(best.filter(F.col("c.gain") > F.col("least")), "splits")
        if splits.isEmpty():
            break
        found.append(splits.select(*group, F.col("c.before").alias("position"), F.col("c.at").alias(time), F.lit(level).alias("level"), F.col("c.gain").alias("gain")))
        left = splits.select(*group, "a", F.col("c.before").alias("b"), "sum_a", F.col("c.sum_before").alias("sum_b"), "least")
        right = splits.select(*group, F.col("c.before").alias("a"), "b", F.col("c.sum_before").alias("sum_a"), "sum_b", "least")
        at = checked_broadcast(splits.select(*group, "a", F.col("c.before").alias("_cut")), "cuts", stored=True)
        moved = cells.join(at, [*group, "a"])
        moved = moved.withColumn("a", F.when(F.col("before") >= F.col("_cut"), F.col("_cut")).otherwise(F.col("a"))).drop("_cut")
        cells = materialize(moved, "open-cells")
        open_ = left.unionByName(right).join(cells.groupBy(*group, "a").agg(F.count(F.lit(1)).alias("cells")), [*group, "a"])
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def segment(
    df: DataFrame, columns: list[str], by: list[str], time: str = "tx_datetime", penalty: float = PENALTY,
    min_size: int = MIN_SIZE, split_above: int = SPLIT_ABOVE, task_cells: int = TASK_CELLS,
) -> DataFrame:
    """Cuts of every column's whole series, per group."""
    return segment_series(ordered_series(df, columns, by, time, split_above), by, time, penalty, min_size, task_cells)
