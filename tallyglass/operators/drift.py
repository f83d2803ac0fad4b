"""Comparison of each day with the previous available day, for every column of every day at once.

Rows shrink first: one shuffle turns them into cells (day pair, column, value, copies today, copies
before). Ranks, distribution functions, medians and deciles are read off running sums over the cells;
only one summary row per pair and column is joined back. p-values are computed on those summaries.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from tallyglass.functions.numeric import ratio_or
from tallyglass.functions.tails import chi2_upper, f_upper, normal_two_sided, student_t_two_sided
from tallyglass.operators.profile import calendar, moments
from tallyglass.operators.ranks import SPLIT_ABOVE, running_sums
from tallyglass.workspace import checked_broadcast, materialize

# Significance level, number of stability bins, and the floor of a bin share.
ALPHA = 0.05
OMNIBUS_ROWS = 8
PSI_BINS = 10
PSI_FLOOR = 1e-4


def values_long(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """(keep, feature, value) with nulls removed."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.*").filter("value is not null")


def day_moments(df: DataFrame, columns: list[str], day: str = "date") -> DataFrame:
    """Count, mean, sample variance, skewness, excess kurtosis per day and column."""
    table = moments(df.filter(F.col(day).isNotNull()), [day], columns)
    return table.select(
        day,
        F.col("column").alias("feature"),
        F.col("non_null").alias("n"),
        "mean",
        "var",
        F.col("skewness").alias("skew"),
        F.col("kurtosis").alias("kurt"),
    )


def jarque_bera(table: DataFrame) -> DataFrame:
    """Normality from skewness and kurtosis: statistic, p = exp(-JB / 2), verdict (null when undefined)."""
    jb = F.col("n") / F.lit(6.0) * (F.col("skew") * F.col("skew") + F.col("kurt") * F.col("kurt") / F.lit(4.0))
    return table.withColumn("jb", jb).withColumn("p_value", F.exp(-F.col("jb") / F.lit(2.0))).withColumn(
        "normal", F.col("p_value") >= ALPHA
    )


def omnibus(table: DataFrame) -> DataFrame:
    """Normality by the D'Agostino-Pearson K-squared of all values: statistic, p-value, verdict.

    Null for fewer than 8 values or a constant column.
    """
    n = F.when(F.col("n") >= OMNIBUS_ROWS, F.col("n").cast("double"))
    y = F.col("skew") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta - 1)) - 1
    z1 = F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(0.5 * F.log(w2))
    mean = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("kurt") + 3 - mean) / F.sqrt(var)
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    under = 1 + x * F.sqrt(2 / (a - 4))
    size = F.when(under != 0, F.abs(under))
    z2 = (1 - 2 / (9 * a) - F.signum(under) * F.cbrt((1 - 2 / a) / size)) / F.sqrt(2 / (9 * a))
    k2 = z1 * z1 + z2 * z2
    return table.withColumn("k2", k2).withColumn("p_value", F.exp(-F.col("k2") / F.lit(2.0))).withColumn(
        "normal", F.col("p_value") >= ALPHA
    )


def paired_moments(table: DataFrame, days: DataFrame, day: str = "date") -> DataFrame:
    """Each day's moments beside those of its previous available day."""
    sides = [
        table.select(
            F.col(day).alias(name), "feature", *[F.col(c).alias(f"{c}_{side}") for c in ("n", "mean", "var", "skew", "kurt")]
        )
        for side, name in (("cur", day), ("ref", "prev_date"))
    ]
    linked = days.filter("prev_date is not null").select(day, "prev_date")
    return sides[0].join(linked, day).join(sides[1], ["prev_date", "feature"])


def pooled_t(paired: DataFrame) -> DataFrame:
    """Student t with pooled variance: ``t`` and ``t_df``."""
    df = F.col("n_cur") + F.col("n_ref") - 2
    pooled = ratio_or((F.col("n_cur") - 1) * F.col("var_cur") + (F.col("n_ref") - 1) * F.col("var_ref"), df, None)
    error = F.sqrt(pooled * (1 / F.col("n_cur").cast("double") + 1 / F.col("n_ref").cast("double")))
    return paired.withColumn("t", ratio_or(F.col("mean_cur") - F.col("mean_ref"), error, None)).withColumn("t_df", df.cast("double"))


def pair_cells(df: DataFrame, columns: list[str], days: DataFrame, day: str = "date") -> DataFrame:
    """(date, feature, value, n_cur, n_ref): copies of each value on a day and on the day before it.

    Every row counts for its own day and, as reference, for the next one. Copies are summed map-side.
    """
    present = df.join(days, day).select(day, "prev_date", "next_date", *columns)
    long = values_long(present, columns, [day, "prev_date", "next_date"])
    roles = F.array(
        F.struct(F.when(F.col("prev_date").isNotNull(), F.col(day)).alias("d"), F.lit(1).alias("c"), F.lit(0).alias("r")),
        F.struct(F.col("next_date").alias("d"), F.lit(0).alias("c"), F.lit(1).alias("r")),
    )
    return (
        long.select("feature", "value", F.explode(roles).alias("role"))
        .filter("role.d is not null")
        .groupBy(F.col("role.d").alias(day), "feature", "value")
        .agg(F.sum("role.c").alias("n_cur"), F.sum("role.r").alias("n_ref"))
    )


def _value_at(index: Column, before: str, copies: str) -> Column:
    """Aggregate: the value at a zero-based position of one side."""
    inside = (F.col(before) <= index) & (index < F.col(before) + F.col(copies))
    return F.max(F.when(inside, F.col("value")))


def rank_summary(cells: DataFrame, day: str = "date", split_above: int = SPLIT_ABOVE) -> DataFrame:
    """One row per pair and column from stored cells: rank test, KS distance, medians, reference deciles.

    ``cells`` must already be stored, because totals and running sums both read it.
    """
    group = [day, "feature"]
    totals = cells.groupBy(*group).agg(F.sum("n_cur").alias("n1"), F.sum("n_ref").alias("n2"))
    totals = totals.filter("n1 > 0 and n2 > 0")
    axis = running_sums(cells, group, "value", {"b_cur": "n_cur", "b_ref": "n_ref"}, split_above=split_above, label=None)
    n, n1, n2 = F.col("n_cur") + F.col("n_ref"), F.col("n1"), F.col("n2")
    rank = F.col("b_cur") + F.col("b_ref") + (n + 1) / F.lit(2.0)
    gap = (F.col("b_cur") + F.col("n_cur")) / n1.cast("double") - (F.col("b_ref") + F.col("n_ref")) / n2.cast("double")
    nd = n.cast("double")
    expected = {side: nd * total / (n1 + n2) for side, total in (("n_cur", n1), ("n_ref", n2))}
    chi2 = sum((F.col(side) - e) * (F.col(side) - e) / e for side, e in expected.items())
    decile = [F.floor((n2 * j + PSI_BINS - 1) / PSI_BINS) - 1 for j in range(1, PSI_BINS)]
    rows = axis.join(checked_broadcast(totals, "pair-totals"), group)
    summary = rows.groupBy(*group, "n1", "n2").agg(
        F.sum(F.col("n_cur") * rank).alias("rank_sum"),
        F.sum(nd * nd * nd - nd).alias("ties"),
        F.max(F.abs(gap)).alias("ks"),
        F.sum(chi2).alias("chi2"),
        (F.count(F.lit(1)) - 1).alias("chi2_df"),
        ((_value_at(F.floor((n1 - 1) / 2), "b_cur", "n_cur") + _value_at(F.floor(n1 / 2), "b_cur", "n_cur")) / 2).alias("median_cur"),
        ((_value_at(F.floor((n2 - 1) / 2), "b_ref", "n_ref") + _value_at(F.floor(n2 / 2), "b_ref", "n_ref")) / 2).alias("median_ref"),
        F.array_distinct(F.array(*[_value_at(k, "b_ref", "n_ref") for k in decile])).alias("edges"),
    )
    return _rank_tests(summary)


def _rank_tests(summary: DataFrame) -> DataFrame:
    """U of the current day, its tie-corrected z with continuity correction, and the KS series p-value."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    spread = n1 * n2 / 12 * (n + 1 - F.when(n > 1, F.col("ties") / (n * (n - 1))).otherwise(0.0))
    z = ratio_or(F.greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5, F.sqrt(F.greatest(spread, F.lit(0.0))), None)
    return summary.withColumn("u", u).withColumn("z", z).withColumn("ks_p", kolmogorov_p(F.col("ks"), n1, n2))


def kolmogorov_p(distance: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sample p-value: the alternating Kolmogorov series, inside the JVM."""
    scaled = distance * F.sqrt(n1 * n2 / (n1 + n2))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.lit(-2.0) * k * k * scaled * scaled),
    )
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * series)))


@pandas_udf(DoubleType())
def _exact_rank_p(u: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) else _exact_u(float(x), int(min(a, b)), int(max(a, b))) for x, a, b in zip(u, n1, n2)], dtype="object")


def mann_whitney_p(method: str = "asymptotic") -> Column:
    """p-value of ``u``: the normal tail of ``z``, or by request the exact null distribution, which takes no ties."""
    if method not in ("asymptotic", "exact"):
        raise ValueError("method must be asymptotic or exact")
    tail = F.when(F.col("z") >= 0, normal_two_sided("z")).otherwise(F.when(F.col("z") < 0, F.lit(1.0)))
    return tail if method == "asymptotic" else F.when(F.col("ties") == 0, _exact_rank_p("u", "n1", "n2"))


def _exact_u(stat: float, m: int, n: int) -> float:
    """Two-sided p from the Gaussian binomial coefficients (number of orderings per value of U)."""
    ways = np.zeros(m * n + 1)
    ways[0] = 1.0
    for i in range(1, m + 1):
        top = n + i
        shifted = ways.copy()
        shifted[top:] -= ways[:-top] if top <= m * n else 0.0
        for start in range(i):
            shifted[start::i] = np.cumsum(shifted[start::i])
        ways = shifted
    high = max(stat, m * n - stat)
    return float(min(1.0, 2.0 * ways[int(math.ceil(high)) :].sum() / ways.sum()))


def spread_and_stability(
    cells: DataFrame, summary: DataFrame, day: str = "date", stored: bool = False
) -> DataFrame:
    """Second pass over the cells with medians and deciles known: Levene F and the stability index."""
    group = [day, "feature"]
    known = summary.select(*group, "n1", "n2", "median_cur", "median_ref", "edges")
    rows = cells.join(checked_broadcast(known, "pair-summary", stored=stored), group)
    bin_of = F.size(F.filter("edges", lambda e: e < F.col("value")))
    dev = {s: F.abs(F.col("value") - F.col(f"median_{s}")) for s in ("cur", "ref")}
    sums = [
        F.sum(F.col(f"n_{s}") * dev[s] ** power).alias(f"{name}_{s}")
        for s in ("cur", "ref")
        for name, power in (("z", 1), ("zz", 2))
    ]
    bins = rows.groupBy(*group, "n1", "n2", bin_of.alias("bin")).agg(
        F.sum("n_cur").alias("c"), F.sum("n_ref").alias("r"), *sums
    )
    floor = F.lit(PSI_FLOOR)
    p, q = F.greatest(F.col("c") / F.col("n1"), floor), F.greatest(F.col("r") / F.col("n2"), floor)
    table = bins.groupBy(*group, "n1", "n2").agg(
        F.sum((p - q) * F.log(p / q)).alias("psi"), *[F.sum(c).alias(c) for c in ("z_cur", "zz_cur", "z_ref", "zz_ref")]
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    m1, m2 = F.col("z_cur") / n1, F.col("z_ref") / n2
    m = (F.col("z_cur") + F.col("z_ref")) / (n1 + n2)
    between = n1 * (m1 - m) * (m1 - m) + n2 * (m2 - m) * (m2 - m)
    within = F.col("zz_cur") - n1 * m1 * m1 + F.col("zz_ref") - n2 * m2 * m2
    df2 = n1 + n2 - 2
    # Differences of sums leave rounding noise where nothing varies.
    real = F.when(within > 1e-12 * (F.col("zz_cur") + F.col("zz_ref")), within)
    return table.select(*group, "psi", (df2 * between / real).alias("levene"), df2.alias("levene_df"))


def compare_days(
    df: DataFrame,
    columns: list[str],
    day: str = "date",
    categorical: list[str] | None = None,
    split_above: int = SPLIT_ABOVE,
    rank_method: str = "asymptotic",
) -> DataFrame:
    """All tests, p-values and the decision for each (day, column) against the previous available day.

    ``verdict``: ``different_nature`` when only one side looks normal; otherwise ``similar`` or
    ``different`` by the t test (both normal; ``unequal_variance`` notes a failed Levene test) or by
    the rank test (neither normal); ``undecided`` without a defined normality (constant columns). A column
    with values on one of the two days only is ``undecided`` too, without statistics, and noted ``one_sided``.
    """
    shapes = materialize(day_moments(df, columns, day), "moments")
    days = checked_broadcast(calendar(shapes, day), "calendar")
    paired = pooled_t(paired_moments(shapes, days, day)).drop("prev_date")
    cells = materialize(pair_cells(df, columns, days, day), "pair-cells")
    ranks = materialize(rank_summary(cells, day, split_above), "rank-summary")
    spread = spread_and_stability(cells, ranks, day, stored=True)
    normality = jarque_bera(shapes).select(F.col(day).alias("d"), F.col("feature").alias("f"), "jb", "p_value", "normal")
    sides = {
        s: normality.select(
            F.col("d").alias(d), F.col("f").alias("feature"),
            F.col("jb").alias(f"jb_{s}"), F.col("p_value").alias(f"jb_p_{s}"), F.col("normal").alias(f"normal_{s}"),
        )
        for s, d in (("cur", day), ("ref", "prev_date"))
    }
    pairs = cells.groupBy(day, "feature").agg(F.sum("n_cur").alias("n1"), F.sum("n_ref").alias("n2"))
    wide = (
        pairs.join(days.select(day, "prev_date"), day)
        .join(paired, [day, "feature"], "left")
        .join(ranks.drop("edges", "n1", "n2"), [day, "feature"], "left")
        .join(spread, [day, "feature"], "left")
        .join(sides["cur"], [day, "feature"], "left")
        .join(sides["ref"], ["prev_date", "feature"], "left")
    )
    # Small result: one row per day and column, so the folds of the tails run on few rows.
    wide = (
        wide.withColumn("t_p", student_t_two_sided("t", "t_df"))
        .withColumn("levene_p", f_upper("levene", F.lit(1.0), "levene_df"))
        .withColumn("u_p", mann_whitney_p(rank_method))
        .withColumn("chi2_p", F.when(F.col("chi2_df") > 0, chi2_upper("chi2", "chi2_df")).when(F.col("chi2_df") == 0, F.lit(1.0)))
    )
    kinds = F.col("feature").isin(categorical or [])
    same = lambda p: F.when(F.col(p) >= ALPHA, "similar").otherwise("different")
    verdict = (
        F.when(F.col("normal_cur").isNull() | F.col("normal_ref").isNull(), "undecided")
        .when(F.col("normal_cur") != F.col("normal_ref"), "different_nature")
        .when(F.col("normal_cur"), same("t_p"))
        .otherwise(same("u_p"))
    )
    note = F.when((F.col("n1") == 0) | (F.col("n2") == 0), "one_sided").when(
        F.col("normal_cur") & F.col("normal_ref") & (F.col("levene_p") < ALPHA), "unequal_variance"
    )
    return wide.withColumns(
        {
            "verdict": verdict,
            "note": F.coalesce(note, F.lit("")),
            "drift_test": F.when(kinds, "chi_square").otherwise("kolmogorov_smirnov"),
            "drift_p": F.when(kinds, F.col("chi2_p")).otherwise(F.col("ks_p")),
        }
    )


# Test name -> (statistic column, p-value column) of a comparison row.
TESTS = {
    "jarque_bera_cur": ("jb_cur", "jb_p_cur"),
    "jarque_bera_ref": ("jb_ref", "jb_p_ref"),
    "levene": ("levene", "levene_p"),
    "student_t": ("t", "t_p"),
    "mann_whitney": ("u", "u_p"),
    "kolmogorov_smirnov": ("ks", "ks_p"),
    "chi_square": ("chi2", "chi2_p"),
}


def test_log(comparison: DataFrame, day: str = "date") -> DataFrame:
    """Long log: (date, feature, test, statistic, p_value, passed, note); the stability index has no p."""
    rows = [
        F.struct(F.lit(t).alias("test"), F.col(s).cast("double").alias("statistic"), F.col(p).alias("p_value"))
        for t, (s, p) in TESTS.items()
    ]
    rows.append(
        F.struct(F.lit("stability_index").alias("test"), F.col("psi").alias("statistic"), F.lit(None).cast("double").alias("p_value"))
    )
    out = comparison.select(day, "feature", "note", F.explode(F.array(*rows)).alias("r"))
    return out.select(day, "feature", "r.*", (F.col("r.p_value") >= ALPHA).alias("passed"), "note")


def drifted_columns(comparison: DataFrame, day: str = "date") -> DataFrame:
    """Per day: how many columns drifted, their share, and the number compared.

    A column that is filled on one of the two days only has drifted.
    """
    drifted = F.count_if((F.col("drift_p") < ALPHA) | (F.col("note") == "one_sided"))
    return comparison.groupBy(day).agg(
        drifted.alias("drifted"), F.count(F.lit(1)).alias("compared"), ratio_or(drifted, F.count(F.lit(1))).alias("share")
    )
