import math
import random
import statistics

import pytest

from tallyglass.operators import normality

SCHEMA = "g string, x double"


def outcome(spark, values, **options):
    df = spark.createDataFrame([("a", None if v is None else float(v)) for v in values], SCHEMA).repartition(3)
    return normality.shapiro_wilk(df, ["x"], ["g"], **options).first()


def direct(values):
    """The statistic from sorted values, the plain way."""
    x, n = sorted(values), len(values)
    m = [statistics.NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    total, u = sum(v * v for v in m), 1 / math.sqrt(n)
    poly = lambda c: sum(k * u**i for i, k in enumerate(c))
    weights = [0.0] * n
    weights[-1] = math.sqrt(0.5) if n == 3 else poly(normality.LAST_WEIGHT) + m[-1] / math.sqrt(total)
    outer = 1
    if n > 5:
        weights[-2], outer = poly(normality.NEXT_WEIGHT) + m[-2] / math.sqrt(total), 2
        scale = (total - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * weights[-1] ** 2 - 2 * weights[-2] ** 2)
    elif n > 3:
        scale = (total - 2 * m[-1] ** 2) / (1 - 2 * weights[-1] ** 2)
    for i in range(outer):
        weights[i] = -weights[-1 - i]
    for i in range(outer, n - outer):
        weights[i] = m[i] / math.sqrt(scale) if n > 3 else 0.0
    mean = sum(x) / n
    return sum(a * v for a, v in zip(weights, x)) ** 2 / sum((v - mean) ** 2 for v in x)


def test_published_example(spark):
    got = outcome(spark, [148.0, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert got.w == pytest.approx(0.78881, abs=1e-5) and got.p_value == pytest.approx(0.0067, abs=1e-4) and not got.normal


@pytest.mark.parametrize("n", [3, 4, 5, 6, 11, 12, 50, 3000, 6000])
def test_equals_direct_weights(spark, n, monkeypatch):
    monkeypatch.setattr(normality, "STRETCH", 7)
    rng = random.Random(n)
    values = [rng.gauss(5, 2) for _ in range(n)]
    if n > 11:
        values = [round(v, 1) if n == 50 else round(v, 2) for v in values]  # ties
    got = outcome(spark, values, split_above=500)
    assert got.n == n and got.w == pytest.approx(direct(values), abs=1e-9)
    if n > 5000:
        assert got.p_value is None and got.normal is None and got.note == "beyond_5000"
    else:
        assert 0 <= got.p_value <= 1 and got.note == ""


def test_p_values_follow_the_sample(spark):
    rng = random.Random(1)
    rows = []
    for g in range(60):
        rows += [(f"n{g}", rng.gauss(0, 1)) for _ in range(80)] + [(f"e{g}", rng.expovariate(1)) for _ in range(80)]
    got = {r.g: r.normal for r in normality.shapiro_wilk(spark.createDataFrame(rows, SCHEMA), ["x"], ["g"]).collect()}
    assert sum(v for k, v in got.items() if k[0] == "n") >= 50 and not any(v for k, v in got.items() if k[0] == "e")


def test_three_values_are_exact(spark):
    assert outcome(spark, [1.0, 2.0, 3.0]).p_value == pytest.approx(1.0, abs=1e-6)
    assert outcome(spark, [0.0, 0.0, 1.0]).p_value == pytest.approx(0.0, abs=1e-6)


def test_undefined_cases(spark):
    assert tuple(outcome(spark, [1.0, 2.0, None]))[1:] == ("x", 2, None, None, None, "too_few")
    assert tuple(outcome(spark, [4.0] * 9))[1:] == ("x", 9, None, None, None, "constant")
    assert normality.shapiro_wilk(spark.createDataFrame([], SCHEMA), ["x"], ["g"]).count() == 0


def test_normal_quantile_inverts_the_normal(spark):
    points = [1e-300, 1e-20, 1e-9, 0.001, 0.02, 0.07, 0.0751, 0.3, 0.5, 0.8, 0.93, 0.999, 1 - 1e-12]
    for p in points:
        q = spark.range(1).selectExpr(f"{normality.normal_quantile(f'{p!r}D')} as q").first().q
        assert 0.5 * math.erfc(-q / math.sqrt(2)) == pytest.approx(p, rel=1e-12)
