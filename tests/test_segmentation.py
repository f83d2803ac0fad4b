import datetime as dt
import math
import random

import numpy as np
import pytest

from tallyglass.operators import segmentation

SCHEMA = "date date, at timestamp_ntz, v double, flat double"
T0 = dt.datetime(2024, 1, 1)


def direct(points, penalty, min_size=2):
    """Binary segmentation of (time, value) points, the plain way; equal times stay together."""
    points = sorted(points)
    values = [v for _, v in points]
    n = len(values)
    mean = sum(values) / n
    std = math.sqrt(sum((v - mean) ** 2 for v in values) / n)
    x = [(v - mean) / std for v in values]

    def error(a, b):
        part = x[a:b]
        return sum(p * p for p in part) - sum(part) ** 2 / len(part)

    cuts, open_ = [], [(0, n)]
    while open_:
        a, b = open_.pop()
        options = [(round(error(a, b) - error(a, k) - error(k, b), 6), -k) for k in range(a + min_size, b - min_size + 1) if points[k][0] != points[k - 1][0]]
        if options and max(options)[0] > penalty * math.log(n):
            k = -max(options)[1]
            cuts.append(k)
            open_ += [(a, k), (k, b)]
    return sorted(cuts)


@pytest.mark.parametrize("split_above", [1_000_000, 40])
def test_equals_direct_segmentation(spark, split_above):
    rng = random.Random(split_above)
    rows, want = [], {}
    for d in range(5):
        day, points, level = dt.date(2024, 1, 1 + d), [], 0.0
        for i in range(160):
            if rng.random() < 0.04:
                level = rng.uniform(-5, 5)
            points.append((T0 + dt.timedelta(days=d, seconds=i * 2 // 3), level + rng.gauss(0, 0.4)))
        rows += [(day, t, v, 1.0) for t, v in points] + [(day, None, 3.0, 1.0), (day, points[0][0], None, 1.0)]
        want[day] = direct(points, 2.0)
    got = segmentation.segment(spark.createDataFrame(rows, SCHEMA).repartition(4), ["v", "flat"], ["date"], "at", 2.0, split_above=split_above).collect()
    assert {r.feature for r in got} == {"v"}
    assert {day: sorted(r.position for r in got if r.date == day) for day in want} == want and sum(map(len, want.values())) > 10
    for r in got:
        times = sorted(t for d, t, v, _ in rows if d == r.date and t is not None and v is not None)
        assert times[r.position] == r["at"] and times[r.position - 1] < r["at"]


def test_no_cut_and_no_rows(spark):
    flat = [(dt.date(2024, 1, 1), T0 + dt.timedelta(seconds=i), float(i % 2), 1.0) for i in range(50)]
    for rows in (flat, flat[:1], []):
        got = segmentation.segment(spark.createDataFrame(rows, SCHEMA), ["v", "flat"], ["date"], "at")
        assert got.count() == 0 and got.columns == ["date", "feature", "position", "at", "level", "gain"]


def test_levels_in_jobs_and_in_tasks_agree(spark):
    rng, day = random.Random(7), dt.date(2024, 1, 1)
    points = [(T0 + dt.timedelta(seconds=i), (i % 40) + rng.gauss(0, 0.5)) for i in range(400)]
    df = spark.createDataFrame([(day, t, v, 1.0) for t, v in points], SCHEMA).repartition(4)
    found = [segmentation.segment(df, ["v"], ["date"], "at", 1.0, task_cells=n).collect() for n in (1, 150, 1000)]
    assert len({r.level for r in found[0]}) > 3
    assert sorted(found[0]) == sorted(found[1]) == sorted(found[2])
    assert sorted(r.position for r in found[0]) == direct(points, 1.0)


def test_jobs_do_not_grow_with_levels(spark):
    day = dt.date(2024, 1, 1)
    rows = [(day, T0 + dt.timedelta(seconds=i), 2.0 ** (i // 5), 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    context = spark.sparkContext
    context.setJobGroup("whole-series", "cuts of growing steps")
    try:
        found = segmentation.segment(df, ["v"], ["date"], "at", 1e-9).collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert max(r.level for r in found) >= 8
    assert len(context.statusTracker().getJobIdsForGroup("whole-series")) < 30


@pytest.mark.parametrize("kind", ["steps", "teeth", "flat", "broken"])
def test_frames_lose_no_cut(kind):
    rng = np.random.default_rng(3)
    copies = rng.integers(1, 4, 3000)
    values = {
        "steps": np.repeat(rng.normal(0, 3, 30), 100) + rng.normal(0, 1, 3000), "teeth": np.arange(3000) % 50 / 10.0,
        "flat": np.tile([1.0, -1.0], 1500), "broken": np.where(np.arange(3000) < 2990, 1.0, np.nan),
    }[kind]
    values = (values - np.average(values, weights=copies)) * copies
    before, sums = np.concatenate(([0], np.cumsum(copies)[:-1])), np.concatenate(([0.0], np.cumsum(values)[:-1]))
    ends = (0, int(copies.sum()), 0.0, 0.0, 8.0, 2)
    whole = segmentation.Cells(before, sums, 10_000)
    for block in (2, 16, 64):
        assert repr(segmentation.cuts_within(segmentation.Cells(before, sums, block), *ends)) == repr(segmentation.cuts_within(whole, *ends))
