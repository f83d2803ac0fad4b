"""Day states and their roll-ups, frequent values by counters."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyglass.operators import daystates, heavyhitters, profile

SCHEMA = "date date, a double, b int"


def day_rows(seed=1, days=12, size=400):
    rng = random.Random(seed)
    rows = [
        (dt.date(2024, 1, 25) + dt.timedelta(days=rng.randrange(days)), rng.choice([None, -0.0, 0.0, rng.gauss(1e6, 3), rng.random()]), rng.choice([None, 1, 2, 3]))
        for _ in range(size * days)
    ]
    return rows + [(None, 1.0, 1), (dt.date(2024, 3, 1), None, None)]


def test_merged_states_equal_direct_states(spark, tmp_path):
    df = spark.createDataFrame(day_rows(), SCHEMA)
    path = str(tmp_path / "states")
    daystates.store(daystates.day_states(df), path)
    daystates.store(daystates.day_states(df.filter("date >= '2024-01-30'")), path)  # written again: replaced
    days = daystates.stored(spark, path)
    for period in ("week", "month"):
        merged = {(r.date, r.column): r for r in daystates.summary(daystates.roll_up(days, period)).collect()}
        wide = df.withColumn("date", F.trunc("date", period))
        direct = {(r.date, r.column): r for r in daystates.summary(daystates.day_states(wide)).collect()}
        assert set(merged) == set(direct)
        for key, m in merged.items():
            d = direct[key]
            assert (m.rows, m.non_null, m.min, m.max, m.distinct_values) == (d.rows, d.non_null, d.min, d.max, d.distinct_values)
            assert (m.mean is None) == (d.mean is None) and (m.q is None) == (d.q is None)
            if m.mean is not None:
                assert m.mean == pytest.approx(d.mean, rel=1e-12) and m.std == pytest.approx(d.std, rel=1e-9, abs=1e-9)
    # Months of weeks' worth of days, then the total, equal the total of the days.
    whole = daystates.merge(daystates.roll_up(days, "month"), [])
    again = daystates.merge(days, [])
    assert [r[:2] for r in sorted(daystates.summary(whole).drop("q").collect())] == [r[:2] for r in sorted(daystates.summary(again).drop("q").collect())]


def test_sketch_errors_against_the_exact_profile(spark):
    rng = random.Random(2)
    rows = [(dt.date(2024, 1, 1 + i % 9), rng.lognormvariate(0, 3), rng.randrange(50)) for i in range(60_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    told = {r.column: r for r in daystates.summary(daystates.merge(daystates.day_states(df), [])).collect()}
    exact = {r.column: r for r in profile.profile(df, [], ["a", "b"]).collect()}
    ordered = sorted(r[1] for r in rows)
    for p, value in zip(daystates.QUARTILES, told["a"].q):
        rank = sum(v <= value for v in ordered) / len(ordered)
        assert abs(rank - p) <= daystates.RANK_ERROR
    assert abs(told["a"].distinct_values / 60_000 - 1) <= daystates.DISTINCT_ERROR and told["b"].distinct_values == 50
    for column in ("a", "b"):
        assert told[column].mean == pytest.approx(exact[column].mean) and told[column].std == pytest.approx(exact[column].std)


def test_states_of_nothing(spark):
    empty = daystates.day_states(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and daystates.roll_up(empty, "week").count() == 0
    with pytest.raises(ValueError):
        daystates.roll_up(empty, "decade")


def test_merging_reads_no_row_again(spark, tmp_path):
    df = spark.createDataFrame(day_rows(3, 3, 20), SCHEMA)
    daystates.store(daystates.day_states(df), str(tmp_path / "s"))
    plan = daystates.summary(daystates.roll_up(daystates.stored(spark, str(tmp_path / "s")), "week"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Generate" not in plan


def value_rows(seed):
    rng = random.Random(seed)
    out = []
    for i in range(3000):
        skewed = "v%d" % min(rng.randrange(1, 60), rng.randrange(1, 60)) if rng.random() < 0.7 else f"rare{i}"
        out.append((rng.choice(["x", "y", None]), skewed, i, rng.choice([None, "only"]), rng.choice(["a", "b", "c"])))
    return out + [("lone", "z", 1, None, "a")]


@pytest.mark.parametrize("capacity", [2, 10, 100, 10_000])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_frequent_values_equal_full_counts(spark, monkeypatch, capacity, by):
    monkeypatch.setattr(heavyhitters, "TASK_COUNTERS", 500 if capacity == 100 else 2_000_000)
    df = spark.createDataFrame(value_rows(capacity), "g string, skewed string, flat int, single string, few string").repartition(5)
    columns = ["skewed", "flat", "single", "few"]
    got = heavyhitters.frequent_values(df, columns, 4, by, capacity)
    expected = profile.top_values(df, columns, 4, by)
    assert got.columns == expected.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, expected.collect())))


def test_counters_are_bounded_and_bracket_the_counts(spark):
    rows = value_rows(9)
    df = spark.createDataFrame(rows, "g string, skewed string, flat int, single string, few string").repartition(4)
    out = heavyhitters.summaries(df, ["skewed", "flat"], [], 40).collect()
    assert len(out) <= 4 * 2 * 41
    for code, column in ((0, 1), (1, 2)):
        true, low, error = {}, {}, sum(r.error for r in out if r.code == code)
        for r in rows:
            true[str(r[column])] = true.get(str(r[column]), 0) + 1
        for r in out:
            if r.code == code and r.value is not None:
                low[r.value] = low.get(r.value, 0) + r.low
        assert all(low.get(v, 0) <= n <= low.get(v, 0) + error for v, n in true.items())


def test_no_rows(spark):
    empty = spark.createDataFrame([], "g string, a string")
    assert heavyhitters.frequent_values(empty, ["a"], 3, ["g"]).count() == 0
