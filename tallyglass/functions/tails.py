"""Tail probabilities for finished test statistics (one row per test, never per data row).

Spark has no error function or incomplete beta/gamma; the textbook series and continued fractions are given as plain
functions of numbers and as Columns of built-in expressions.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 300
_TINY = 1e-300


def beta_regularised(a, b, x):
    """I_x(a, b) by Lentz's continued fraction, elementwise."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0)
    for i in np.ndindex(x.shape):
        if ok[i]:
            out[i] = _beta_scalar(float(a[i]), float(b[i]), min(max(float(x[i]), 0.0), 1.0))
    return out


def _beta_scalar(a: float, b: float, x: float) -> float:
    if x in (0.0, 1.0):
        return x
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_scalar(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    d = 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    c, total = 1.0, d
    for m in range(1, _STEPS):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        change = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = c if abs(c) > _TINY else _TINY
            change = d * c
            total *= change
        if abs(change - 1.0) < 1e-15:
            break
    return front * total / a


def gamma_upper_regularised(s: float, x: float) -> float:
    """Q(s, x): power series below s + 1, continued fraction above."""
    if not (math.isfinite(s) and math.isfinite(x)) or s <= 0:
        return math.nan
    if x <= 0:
        return 1.0
    front = math.exp(-x + s * math.log(x) - math.lgamma(s))
    if x < s + 1:
        term = total = 1.0 / s
        k = s
        while term > total * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1.0 - front * total
    b = x + 1 - s
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 10 * _STEPS):
        an = -i * (i - s)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


# The same as Columns: series and continued fractions folded over a sequence of steps, inside the JVM.


def _column(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def log_gamma(x: Column) -> Column:
    """Stirling's series at x + 10, and the ten factors between."""
    y = x + 10
    r = 1 / (y * y)
    series = (1 / F.lit(12.0) - r * (1 / F.lit(360.0) - r * (1 / F.lit(1260.0) - r * (1 / F.lit(1680.0) - r * (1 / F.lit(1188.0) - r * 691 / F.lit(360360.0)))))) / y
    factors = x
    for i in range(1, 10):
        factors = factors * (x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(factors)


def _steps(size: Column) -> Column:
    """The fractions need about the square root of their parameters in steps."""
    return F.sequence(F.lit(1), F.least(F.lit(20 * _STEPS), F.lit(80) + F.ceil(12 * F.sqrt(size)).cast("int")))


def _apart(value: Column) -> Column:
    return F.when(F.abs(value) > _TINY, value).otherwise(F.lit(_TINY))


def _regular(*values: Column) -> Column:
    known = F.lit(True)
    for v in values:
        known = known & v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.coalesce(known, F.lit(False))


def beta_tail(a: Column, b: Column, x: Column) -> Column:
    """I_x(a, b) by Lentz's continued fraction; null for parameters that are not positive numbers."""
    valid = _regular(a, b, x) & (a > 0) & (b > 0)
    a, b = F.when(valid, a).otherwise(1.0), F.when(valid, b).otherwise(1.0)
    x = F.when(valid, F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))).otherwise(0.5)
    turned = x > (a + 1) / (a + b + 2)
    start = F.struct(
        F.when(turned, b).otherwise(a).alias("a"), F.when(turned, a).otherwise(b).alias("b"), F.when(turned, 1 - x).otherwise(x).alias("x"),
        F.lit(1.0).alias("d"), F.lit(1 / _TINY).alias("c"), F.lit(1.0).alias("t"),
    )

    def step(s: Column, i: Column) -> Column:
        m = F.floor(i / F.lit(2)).cast("double")
        even = m * (s.b - m) * s.x / ((s.a + 2 * m - 1) * (s.a + 2 * m))
        odd = -(s.a + m) * (s.a + s.b + m) * s.x / ((s.a + 2 * m) * (s.a + 2 * m + 1))
        # Step 1 is the odd term of m = 0, step 2 the even one of m = 1, and so on.
        term = F.when(i % 2 == 0, even).otherwise(odd)
        moved = F.struct(s.a.alias("a"), s.b.alias("b"), s.x.alias("x"), (1 / _apart(1 + term * s.d)).alias("d"), _apart(1 + term / s.c).alias("c"), s.t.alias("t"))
        return F.transform(F.array(moved), lambda v: F.struct(v.a.alias("a"), v.b.alias("b"), v.x.alias("x"), v.d.alias("d"), v.c.alias("c"), (v.t * v.d * v.c).alias("t")))[0]

    def finish(s: Column) -> Column:
        front = F.exp(log_gamma(s.a + s.b) - log_gamma(s.a) - log_gamma(s.b) + s.a * F.log(s.x) + s.b * F.log1p(-s.x))
        return F.when(s.x <= 0, 0.0).otherwise(front * s.t / s.a)

    part = F.aggregate(_steps(F.greatest(a, b)), start, step, finish)
    return F.when(valid, F.when(turned, 1 - part).otherwise(part))


def gamma_tail(s: Column, x: Column) -> Column:
    """Q(s, x): power series below s + 1, continued fraction above; null where it is not defined."""
    valid = _regular(s, x) & (s > 0)
    s, x = F.when(valid, s).otherwise(1.0), F.when(valid & (x > 0), x).otherwise(1.0)
    start = F.struct(s.alias("s"), x.alias("x"), (1 / s).alias("d"), (1 / s).alias("t"))

    def add(v: Column, i: Column) -> Column:
        term = v.d * v.x / (v.s + i)
        return F.struct(v.s.alias("s"), v.x.alias("x"), term.alias("d"), (v.t + term).alias("t"))

    opened = F.struct(s.alias("s"), x.alias("x"), (1 / (x + 1 - s)).alias("d"), F.lit(1 / _TINY).alias("c"), (1 / (x + 1 - s)).alias("t"))

    def step(v: Column, i: Column) -> Column:
        n = i.cast("double")
        b, term = v.x + 1 - v.s + 2 * n, -n * (n - v.s)
        moved = F.struct(v.s.alias("s"), v.x.alias("x"), (1 / _apart(term * v.d + b)).alias("d"), _apart(b + term / v.c).alias("c"), v.t.alias("t"))
        return F.transform(F.array(moved), lambda w: F.struct(w.s.alias("s"), w.x.alias("x"), w.d.alias("d"), w.c.alias("c"), (w.t * w.d * w.c).alias("t")))[0]

    def front(v: Column) -> Column:
        return F.exp(-v.x + v.s * F.log(v.x) - log_gamma(v.s)) * v.t

    below = 1 - F.aggregate(_steps(s), start, add, front)
    above = F.aggregate(_steps(s), opened, step, front)
    tail = F.when(x < s + 1, below).otherwise(above)
    return F.when(valid, tail)


def normal_two_sided(z: Column | str) -> Column:
    z = _column(z)
    return F.when(z == 0, 1.0).otherwise(gamma_tail(F.lit(0.5), z * z / 2))


def student_t_two_sided(t: Column | str, df: Column | str) -> Column:
    t, df = _column(t), _column(df)
    return beta_tail(df / 2, F.lit(0.5), F.when(_regular(t, df) & (df > 0), df / (df + t * t)))


def f_upper(f: Column | str, d1: Column | str, d2: Column | str) -> Column:
    f, d1, d2 = _column(f), _column(d1), _column(d2)
    return beta_tail(d2 / 2, d1 / 2, F.when(_regular(f, d1, d2) & (d2 > 0) & (d1 * f >= 0), d2 / (d2 + d1 * f)))


def chi2_upper(x: Column | str, k: Column | str) -> Column:
    x, k = _column(x), _column(k)
    return F.when(_regular(x, k) & (k > 0) & (x <= 0), 1.0).otherwise(gamma_tail(k / 2, x / 2))
