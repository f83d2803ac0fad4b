import datetime as dt
import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyglass.functions import tails
from tallyglass.operators import changepoint, drift
from tallyglass.operators.profile import calendar

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _days(spark, ref, cur):
    rows = [(D1, float(v)) for v in ref] + [(D2, float(v)) for v in cur]
    return spark.createDataFrame(rows, "date date, x double")


def _row(spark, ref, cur, **kw):
    return drift.compare_days(_days(spark, ref, cur), ["x"], **kw).first()


def test_tail_values():
    assert math.isclose(float(tails.beta_regularised(4, 0.5, 8 / (8 + 4.0))), 0.0805162, abs_tol=1e-6)  # t = -2, df = 8
    assert math.isclose(tails.gamma_upper_regularised(0.5, 3.841458820694124 / 2), 0.05, abs_tol=1e-9)
    assert math.isclose(tails.gamma_upper_regularised(5, 18.307038053275146 / 2), 0.05, abs_tol=1e-9)
    assert float(tails.beta_regularised(2, 3, 0.0)) == 0.0 and float(tails.beta_regularised(2, 3, 1.0)) == 1.0


def test_tails_as_columns(spark):
    df = spark.createDataFrame([(-2.0, 8.0, 4.0)], "t double, n double, f double")
    row = df.select(
        tails.student_t_two_sided("t", "n").alias("a"),
        tails.f_upper("f", F.lit(1.0), "n").alias("b"),
        tails.normal_two_sided(F.lit(1.959963984540054)).alias("c"),
        tails.chi2_upper(F.lit(3.841458820694124), F.lit(1)).alias("d"),
        tails.student_t_two_sided(F.lit(None).cast("double"), "n").alias("e"),
    ).first()
    assert row.a == pytest.approx(0.0805162, abs=1e-6) and row.b == pytest.approx(row.a, abs=1e-12)
    assert row.c == pytest.approx(0.05, abs=1e-9) and row.d == pytest.approx(0.05, abs=1e-9) and row.e is None


def test_crafted_groups(spark):
    row = _row(spark, [3, 4, 5, 6, 7], [1, 2, 3, 4, 5])
    assert row.t == pytest.approx(-2.0) and row.t_p == pytest.approx(0.0805162, abs=1e-6)
    assert row.levene == pytest.approx(0.0, abs=1e-12) and row.ks == pytest.approx(0.4)
    assert row.median_cur == 3.0 and row.median_ref == 5.0


def test_equal_days_do_not_drift(spark):
    values = [v * v % 37 for v in range(60)]
    row = _row(spark, values, values)
    assert row.ks == 0.0 and row.ks_p == 1.0 and row.psi == pytest.approx(0.0, abs=1e-12) and row.u_p == pytest.approx(1.0, abs=0.01)


def test_exact_rank_distribution_by_request(spark):
    row = _row(spark, [20, 11, 17, 12], [19, 22, 16, 29, 24], rank_method="exact")
    assert row.u == 17.0 and row.u_p == pytest.approx(1 / 9)
    assert _row(spark, [20, 11, 17, 12], [19, 22, 16, 29, 24]).u_p == pytest.approx(math.erfc(6.5 / math.sqrt(20 / 12 * 10) / math.sqrt(2)))


def test_large_samples_use_the_normal_tail(spark):
    rng = random.Random(5)
    a, b = [rng.gauss(0, 1) for _ in range(40)], [rng.gauss(0.3, 1) for _ in range(50)]
    row = _row(spark, a, b)
    u = sum((x > y) + 0.5 * (x == y) for x in b for y in a)
    mean, sd = 1000.0, math.sqrt(2000 * 91 / 12)
    assert row.u == u
    assert row.u_p == pytest.approx(math.erfc((max(u, 2000 - u) - mean - 0.5) / sd / math.sqrt(2)), abs=1e-12)


def test_verdicts(spark):
    normal = lambda m, s, n=300: [NormalDist(m, s).inv_cdf((i + 0.5) / n) for i in range(n)]
    skewed = lambda m, n=300: [m - math.log((i + 0.5) / n) for i in range(n)]
    assert _row(spark, normal(0, 1), normal(0.02, 1)).verdict == "similar"
    shifted = _row(spark, normal(0, 1), normal(2, 3))
    assert (shifted.verdict, shifted.note) == ("different", "unequal_variance")
    assert _row(spark, normal(0, 1), skewed(0)).verdict == "different_nature"
    assert _row(spark, skewed(0), skewed(3)).verdict == "different"
    assert _row(spark, [1.0] * 20, [1.0] * 20).verdict == "undecided"


def test_splitting_hot_groups_changes_nothing(spark):
    rng = random.Random(9)
    a, b = [rng.randrange(500) / 3 for _ in range(400)], [rng.randrange(600) / 3 for _ in range(500)]
    whole, split = _row(spark, a, b), _row(spark, a, b, split_above=20)
    for name in ("u", "ks", "psi", "levene", "median_cur", "median_ref", "ties", "chi2"):
        assert getattr(split, name) == pytest.approx(getattr(whole, name), rel=1e-12)
    assert whole.median_cur == np.median(b) and whole.median_ref == np.median(a)


def test_row_order_does_not_matter(spark):
    a, b = [v % 11 for v in range(80)], [v % 13 for v in range(90)]
    one = _row(spark, a, b)
    two = drift.compare_days(_days(spark, a[::-1], b[::-1]).repartition(5), ["x"]).first()
    assert one.u == two.u and one.psi == pytest.approx(two.psi) and one.ks == two.ks


def test_categorical_columns_use_chi_square(spark):
    row = _row(spark, [0] * 50 + [1] * 50, [0] * 80 + [1] * 20, categorical=["x"])
    table = np.array([[80, 20], [50, 50]])
    expected = np.outer(table.sum(1), table.sum(0)) / table.sum()
    assert row.chi2 == pytest.approx(((table - expected) ** 2 / expected).sum())
    assert row.drift_test == "chi_square" and row.drift_p == row.chi2_p < 0.05


def test_pairs_use_available_days(spark):
    rows = _days(spark, [1, 2], [3]).union(spark.createDataFrame([(dt.date(2024, 1, 9), 4.0)], "date date, x double"))
    cells = drift.pair_cells(rows, ["x"], calendar(rows)).collect()
    assert {(c.date.day, c.value, c.n_cur, c.n_ref) for c in cells} == {(2, 1.0, 0, 1), (2, 2.0, 0, 1), (2, 3.0, 1, 0), (9, 3.0, 0, 1), (9, 4.0, 1, 0)}


def test_omnibus_normality(spark):
    """Values of the published tests for skewness and kurtosis on one series, and the undefined cases."""
    rng = np.random.default_rng(2)
    series = {1: rng.normal(size=500), 2: rng.exponential(size=500), 3: [5.0] * 20, 4: [1.0, 2.0, 4.0], 5: list(range(20))}
    rows = [(dt.date(2024, 1, d), float(v)) for d, values in series.items() for v in values]
    table = drift.omnibus(drift.day_moments(spark.createDataFrame(rows, "date date, x double"), ["x"]))
    got = {r.date.day: r for r in table.collect()}
    assert got[1].p_value > 0.05 and got[2].p_value < 1e-6 and got[3].k2 is None and got[4].k2 is None
    assert got[5].k2 == pytest.approx(1.7058104152122062**2) and got[5].p_value == pytest.approx(math.exp(-got[5].k2 / 2))


def test_one_sided_columns_are_rows(spark):
    rows = [(D1, 1.0, None), (D1, 2.0, None), (D2, 1.5, 3.0), (D2, 2.5, 4.0)]
    compared = drift.compare_days(spark.createDataFrame(rows, "date date, a double, b double"), ["a", "b"])
    got = {r.feature: r for r in compared.collect()}
    assert got.keys() == {"a", "b"} and (got["b"].verdict, got["b"].note) == ("undecided", "one_sided")
    assert got["b"].u_p is None and got["b"].chi2_p is None and (got["b"].n1, got["b"].n2) == (2, 0)
    summary = drift.drifted_columns(compared).first()
    assert summary.compared == 2 and summary.drifted >= 1
    assert drift.test_log(compared).filter("feature = 'b'").count() == len(drift.TESTS) + 1


def test_day_column_of_any_name(spark):
    rows = [(D1, dt.datetime(2024, 1, 1, h), float(h > 11)) for h in range(24)]
    df = spark.createDataFrame(rows, "d date, tx_datetime timestamp, x double")
    found = changepoint.change_points(df, ["x"], cost="l2", penalty=0.5, day="d", jump=1).collect()
    assert [(r.d, r.position) for r in found] == [(D1, 12)]


@pytest.mark.parametrize("cost", changepoint.COSTS)
def test_steps_are_found(cost):
    rng = np.random.default_rng(0)
    series = np.repeat([0.0, 5.0, 1.0], 50) + rng.normal(0, 0.05, 150)
    assert changepoint.segment_starts(series, cost) == [50, 100]
    assert changepoint.segment_starts(np.zeros(100), cost) == []
    assert changepoint.segment_starts(np.array([1.0, 2.0]), cost) == []


def test_search_is_optimal():
    rng = np.random.default_rng(4)
    for _ in range(5):
        x = np.concatenate([rng.normal(m, 1, rng.integers(6, 15)) for m in rng.normal(0, 4, 4)])
        n, cost = len(x), changepoint._segment_cost(x, "l2")
        best = {0: (0.0, [])}
        for end in range(2, n + 1):
            options = [(best[s][0] + cost(s, end) + 3.0, best[s][1] + [s]) for s in best if end - s >= 2]
            if options:
                best[end] = min(options)
        assert changepoint.segment_starts(x, "l2", 3.0, jump=1) == best[n][1][1:]


def test_change_points_per_day(spark):
    rows = spark.range(86400 // 60).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("tx_datetime"),
        F.when(F.col("id") < 720, 0.0).otherwise(9.0).alias("x"),
    ).withColumn("date", F.to_date("tx_datetime"))
    means = changepoint.slot_means(rows, ["x"], "tx_datetime", "date", 100)
    assert means.count() <= 100
    points = changepoint.change_points(rows, ["x"], "l2", max_points=100).collect()
    assert [(p.position, p.second_of_day) for p in points] == [(50, 43200)]
    with pytest.raises(ValueError):
        changepoint.change_points(rows, ["x"], "absent")
