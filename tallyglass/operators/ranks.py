"""Running sums over an ordered axis without a single-task window: ranks, CDFs, exact quantiles.

A global running sum is cut into range buckets. Inside a bucket an ordinary window runs; the total
of the earlier buckets is added afterwards. Buckets follow the data (quantiles of the distinct
values) and their number follows the largest group, so a group that holds most of the table is
spread over as many tasks as it needs. When no group is large, none of this happens.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.workspace import MAX_BROADCAST_ROWS, checked_broadcast, materialize

# A group with more cells than this is split, into buckets of about this size; at most MAX_BUCKETS.
SPLIT_ABOVE = 1_000_000
MAX_BUCKETS = 4096
EDGE_BYTES = 64 * 1024 * 1024


def split_points(
    cells: DataFrame, group: list[str], order: str, split_above: int = SPLIT_ABOVE
) -> tuple[DataFrame, int] | None:
    """Stored ascending ``edges`` of each group above the bound, and a stride; None when every group is small."""
    sizes = cells.groupBy(*group).agg(F.count(F.lit(1)).alias("_cells")).filter(F.col("_cells") > split_above)
    large = materialize(sizes, "large-groups")
    count, biggest = large.agg(F.count(F.lit(1)), F.max("_cells")).first()
    if not count:
        return None
    buckets = min(MAX_BUCKETS, max(2, math.ceil(biggest / split_above)))
    fractions = [i / buckets for i in range(1, buckets)]
    chosen = large.select(*group)
    of_large = cells.join(F.broadcast(chosen) if count <= MAX_BROADCAST_ROWS else chosen, group, "left_semi")
    edges = of_large.groupBy(*group).agg(F.percentile_approx(order, fractions, 2 * buckets).alias("edges"))
    return materialize(edges, "edges"), math.isqrt(buckets) or 1


def with_bucket(cells: DataFrame, group: list[str], order: str, edges: DataFrame, stride: int) -> DataFrame:
    """Add ``_bucket``, the number of edges below ``order`` (0 for groups without edges).

    Two steps of about the square root of the edges each: every ``stride``-th edge gives the stretch,
    the edges of that stretch give the rest. So a row never carries the whole list.
    """
    marks = F.filter("edges", lambda e, i: i % stride == stride - 1)
    coarse = edges.select(*group, marks.alias("_marks"))
    stretches = F.posexplode(F.sequence(F.lit(0), F.size(marks))).alias("_stretch", "_i")
    fine = edges.select(*group, "edges", stretches).select(
        *group, "_stretch", F.slice("edges", F.col("_stretch") * stride + 1, F.lit(stride)).alias("_fine")
    )
    rows_bound = EDGE_BYTES // (8 * stride + 64)
    below = [F.size(F.filter(name, lambda e: e < F.col(order))) for name in ("_marks", "_fine")]
    step = cells.join(checked_broadcast(coarse, "marks", rows_bound), group, "left")
    step = step.select(*cells.columns, below[0].alias("_stretch"))
    step = step.join(checked_broadcast(fine, "stretches", rows_bound), [*group, "_stretch"], "left")
    bucket = F.when(F.col("_fine").isNull(), 0).otherwise(F.col("_stretch") * stride + below[1])
    return step.select(*cells.columns, bucket.alias("_bucket"))


def running_sums(
    cells: DataFrame,
    group: list[str],
    order: str,
    sums: dict[str, str],
    split_above: int = SPLIT_ABOVE,
    label: str | None = "cells",
) -> DataFrame:
    """Exclusive running sums ``{output: input}`` of pre-aggregated ``cells`` along ``order``.

    ``cells`` must hold one row per (group, order): aggregate first, so that repeated values are one
    row. ``group`` names at least one column (a constant one for a whole-table axis). The cells are
    stored once, because they feed both the split points and the sums; ``label=None`` says that the
    caller has stored them. Equal values always share a bucket.
    """
    stored = materialize(cells, label) if label else cells
    split = split_points(stored, group, order, split_above)
    if split is None:
        return _sums_within(stored, group, order, sums)
    cut = with_bucket(stored, group, order, *split)
    # At most MAX_BUCKETS rows per group reach this window.
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*group, "_bucket").agg(*[F.sum(c).alias(f"t_{o}") for o, c in sums.items()])
    offsets = totals.select(
        *group, "_bucket", *[F.coalesce(F.sum(f"t_{o}").over(earlier), F.lit(0)).alias(f"o_{o}") for o in sums]
    )
    local = _sums_within(cut, [*group, "_bucket"], order, sums)
    joined = local.join(offsets, [*group, "_bucket"])
    return joined.select(*cells.columns, *[(F.col(o) + F.col(f"o_{o}")).alias(o) for o in sums])


def _sums_within(cells: DataFrame, keys: list[str], order: str, sums: dict[str, str]) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumns({o: F.coalesce(F.sum(c).over(before), F.lit(0)) for o, c in sums.items()})


def average_ranks(df: DataFrame, group: list[str], value: str, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """One row per distinct value: ``n`` copies and their average rank (ties share it), and the ECDF."""
    cells = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    stored = materialize(cells, "ranks")
    ranked = running_sums(stored, group, value, {"below": "n"}, split_above, None)
    totals = checked_broadcast(stored.groupBy(*group).agg(F.sum("n").alias("rows")), "rank-totals")
    return ranked.join(totals, group).select(
        *group,
        value,
        "n",
        (F.col("below") + (F.col("n") + 1) / F.lit(2.0)).alias("avg_rank"),
        ((F.col("below") + F.col("n")).cast("double") / F.col("rows")).alias("ecdf"),
    )


def value_cells(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, code, value, n): copies of each value of each column, null included; ``code`` indexes ``columns``.

    Rows are unpivoted and summed map-side, so hot days and hot values shrink before the shuffle. Whole
    numbers keep a 64-bit slot of their own (``whole``), which keeps large ids distinct.
    """
    slots = []
    for code, c in enumerate(columns):
        integral = df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long")
        slots.append(
            F.struct(
                F.lit(code).alias("code"),
                (F.col(c) if integral else F.lit(None)).cast("bigint").alias("whole"),
                (F.lit(None) if integral else F.col(c)).cast("double").alias("real"),
            )
        )
    long = df.select(*by, F.explode(F.array(*slots)).alias("v")).select(*by, "v.*")
    counted = long.groupBy(*by, "code", "whole", "real").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("value", F.coalesce("real", F.col("whole").cast("double")))


def cell_quantiles(
    cells: DataFrame, group: list[str], fractions: list[float], split_above: int = SPLIT_ABOVE
) -> DataFrame:
    """Exact quantiles (an actual value, at rank ceil(p * n)) of stored cells: (group, n, q)."""
    filled = cells.filter(F.col("value").isNotNull())
    totals = checked_broadcast(filled.groupBy(*group).agg(F.sum("n").alias("_rows")), "quantile-totals")
    axis = running_sums(filled, group, "value", {"_below": "n"}, split_above, None).join(totals, group)
    picks = []
    for p in fractions:
        rank = F.greatest(F.ceil(F.col("_rows") * F.lit(float(p))), F.lit(1))
        inside = (F.col("_below") < rank) & (rank <= F.col("_below") + F.col("n"))
        picks.append(F.max(F.when(inside, F.col("value"))))
    return axis.groupBy(*group).agg(F.array(*picks).alias("q"))


def quantiles(
    df: DataFrame, by: list[str], columns: list[str], fractions: list[float], split_above: int = SPLIT_ABOVE
) -> DataFrame:
    """Exact quantiles per group and column: (by, column, q)."""
    cells = materialize(value_cells(df, by, columns).drop("whole", "real"), "quantile-cells")
    table = cell_quantiles(cells, [*by, "code"], fractions, split_above)
    names = F.array(*[F.lit(c) for c in columns])
    return table.select(*by, names[F.col("code")].alias("column"), "q")
