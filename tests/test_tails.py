"""Tails as Columns against the plain functions."""

import math

import pytest
from pyspark.sql import functions as F

from tallyglass.functions import tails


def test_columns_equal_plain_functions(spark):
    points = [(t, df) for t in (-40.0, -3.2, -1e-3, 0.0, 0.5, 1.96, 7.0) for df in (1.0, 2.0, 5.0, 30.0, 333.0, 20_000.0)]
    rows = spark.createDataFrame(points, "t double, n double").select(
        "t", "n", tails.student_t_two_sided("t", "n").alias("p"), tails.f_upper(F.abs("t"), F.lit(3.0), "n").alias("f"),
        tails.chi2_upper(F.abs("t") * F.col("n") / 4, "n").alias("c"), tails.normal_two_sided("t").alias("z"),
    ).collect()
    for r in rows:
        f = abs(r.t)
        assert r.p == pytest.approx(float(tails.beta_regularised(r.n / 2, 0.5, r.n / (r.n + r.t * r.t))), abs=1e-10)
        assert r.f == pytest.approx(float(tails.beta_regularised(r.n / 2, 1.5, r.n / (r.n + 3 * f))), abs=1e-10)
        assert r.c == pytest.approx(tails.gamma_upper_regularised(r.n / 2, f * r.n / 8), abs=1e-10)
        assert r.z == pytest.approx(math.erfc(f / math.sqrt(2)), abs=1e-12)


def test_log_gamma(spark):
    for x in (0.5, 1.0, 1.5, 2.0, 9.99, 50.0, 1e4, 1e6):
        got = spark.range(1).select(tails.log_gamma(F.lit(x)).alias("g")).first().g
        assert got == pytest.approx(math.lgamma(x), rel=1e-13, abs=1e-13)


def test_undefined_is_null(spark):
    nan, none = F.lit(float("nan")), F.lit(None).cast("double")
    row = spark.range(1).select(
        tails.student_t_two_sided(nan, F.lit(3.0)), tails.student_t_two_sided(none, F.lit(3.0)), tails.student_t_two_sided(F.lit(1.0), F.lit(0.0)),
        tails.f_upper(F.lit(1.0), F.lit(1.0), none), tails.chi2_upper(F.lit(1.0), F.lit(0)), tails.normal_two_sided(nan), tails.normal_two_sided(none),
    ).first()
    assert list(row) == [None] * 7
    assert spark.range(1).select(tails.chi2_upper(F.lit(0.0), F.lit(3))).first()[0] == 1.0


def test_no_python_in_the_plans(spark, sf_dir):
    from tallyglass.registered import drift

    for name in ("ttest_stat", "levene_stat", "drift_verdict", "mannwhitney_stat"):
        plan = drift.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan, name
