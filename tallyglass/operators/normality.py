"""Shapiro-Wilk over all values, from distributed ranks (Shapiro and Wilk 1965; weights and p-value by Royston 1995).

The weights are expected normal order statistics, which depend on a value's rank and the group's size only. Ranks are
running sums over value cells, so a group that holds most of the table is spread over tasks; a value with many copies
adds up the weights of its ranks in stretches of bounded length. What is left per group are a few sums and the two
smallest and largest values. Nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.numeric import as_numeric, unless_constant
from tallyglass.functions.tails import normal_two_sided
from tallyglass.operators.drift import ALPHA
from tallyglass.operators.ranks import SPLIT_ABOVE, running_sums, value_cells
from tallyglass.workspace import checked_broadcast, materialize

LEAST = 3
# Fixed value: the sample size up to which Royston's approximation of the p-value holds.
MOST_FOR_P = 5000
STRETCH = 4096

# Normal quantiles (Wichura 1988, algorithm AS 241), numerators and denominators by ascending power.
CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
SIDE = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)
# Royston's polynomials (algorithm AS R94), by ascending power.
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SMALL_BOUND = (-2.273, 0.459)
SMALL_MEAN = (0.544, -0.39978, 0.025054, -6.714e-4)
SMALL_LOG_SPREAD = (1.3822, -0.77857, 0.062767, -0.0020322)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_LOG_SPREAD = (-0.4803, -0.082676, 0.0030302)


def polynomial(coefficients: tuple[float, ...], x: str) -> str:
    """SQL text of a polynomial, by Horner's rule; doubles in every engine."""
    text = f"{coefficients[-1]!r}::double"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * ({x}) + {c!r}::double)"
    return text


def _quantile(q: str, inner: str, near: str, side: str, tail: str) -> str:
    def ratio(parts: tuple, x: str) -> str:
        return f"{polynomial(parts[0], x)} / {polynomial(parts[1], x)}"

    return f"""case when abs({q}) <= 0.425::double then {q} * {ratio(CENTRE, inner)}
      else sign({q}) * (case when {near} <= 5.0::double then {ratio(SIDE, side)} else {ratio(TAIL, tail)} end) end"""


def normal_quantile(p: str) -> str:
    """SQL text of the normal quantile of ``p``, accurate to about 16 digits."""
    q, near = f"(({p}) - 0.5::double)", f"sqrt(-ln(least(({p}), 1.0::double - ({p}))))"
    return _quantile(q, f"(0.180625::double - {q} * {q})", near, f"({near} - 1.6::double)", f"({near} - 5.0::double)")


def order_scores(ranks: str, n: str) -> str:
    """Spark SQL text: the order statistics of an array of ranks, step by step so that each part is computed once."""
    parts = f"transform({ranks}, i -> (i - 0.375D) / ({n} + 0.25D))"
    parts = f"transform({parts}, p -> named_struct('q', p - 0.5D, 'near', sqrt(-ln(least(p, 1D - p)))))"
    parts = f"""transform({parts}, t -> named_struct('q', t.q, 'inner', 0.180625D - t.q * t.q, 'near', t.near,
      'side', t.near - 1.6D, 'tail', t.near - 5D))"""
    return f"transform({parts}, t -> {_quantile('t.q', 't.inner', 't.near', 't.side', 't.tail')})"


def order_score(rank: str, n: str) -> str:
    """SQL text of the (approximate) expected normal order statistic of a rank, 1 to n."""
    return normal_quantile(f"(({rank}) - 0.375::double) / (({n}) + 0.25::double)")


def shapiro_wilk(df: DataFrame, columns: list[str], by: list[str], split_above: int = SPLIT_ABOVE) -> DataFrame:
    """(by, feature, n, w, p_value, normal, note) for every group and column.

    Nulls are no values. ``w`` is null for fewer than 3 values (note ``too_few``) and for a constant column
    (``constant``); ``p_value`` and the verdict ``normal`` are null beyond 5,000 values as well (``beyond_5000``).
    """
    group = [*by, "code"]
    cells = value_cells(as_numeric(df, columns), by, columns).filter("value is not null").drop("whole", "real")
    cells = materialize(cells.groupBy(*group, "value").agg(F.sum("n").alias("n")), "normality-cells")
    weight = F.col("n").cast("double")
    size = F.sum("n")
    mean = F.sum(F.col("value") * weight) / F.sum(weight)
    totals = checked_broadcast(cells.groupBy(*group).agg(size.alias("size"), mean.alias("mean")), "normality-totals")
    ranked = running_sums(cells, group, "value", {"below": "n"}, split_above, None).join(totals, group)
    # Stretches of ranks, each short enough for one array.
    first = F.sequence(F.col("below") + 1, F.col("below") + F.col("n"), F.lit(STRETCH).cast("bigint"))
    cut = ranked.withColumn("first", F.explode(first)).withColumn(
        "last", F.least(F.col("first") + STRETCH - 1, F.col("below") + F.col("n"))
    )
    sums = F.expr(
        f"""aggregate({order_scores('sequence(first, last)', 'size')}, named_struct('m', 0D, 'mm', 0D),
          (a, m) -> named_struct('m', a.m + m, 'mm', a.mm + m * m))"""
    )
    off = F.col("value") - F.col("mean")
    scored = cut.withColumn("s", sums).withColumn("off", off).withColumn("copies", (F.col("last") - F.col("first") + 1).cast("double"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("first") <= rank) & (rank <= F.col("last")), F.col("off")))

    n = F.col("size")
    table = scored.groupBy(*group, "size").agg(
        F.sum(F.col("s.m") * F.col("off")).alias("mx"),
        F.sum("s.mm").alias("mm"),
        F.sum(F.col("off") * F.col("off") * F.col("copies")).alias("ss"),
        unless_constant(F.lit(1.0), "value").alias("varied"),
        at(F.lit(1)).alias("x1"),
        at(F.lit(2)).alias("x2"),
        at(n - 1).alias("y2"),
        at(n).alias("y1"),
    )
    names = F.array(*[F.lit(c) for c in columns])
    out = p_values(statistic(table).withColumnRenamed("size", "n"))
    return out.select(*by, names[F.col("code")].alias("feature"), "n", "w", "p_value", (F.col("p_value") >= ALPHA).alias("normal"), "note")


def weight_steps() -> dict[str, str]:
    """SQL texts that lead from the sums of a group to the weighted sum ``fit``; each may use those before it."""
    u = "(1.0::double / sqrt(size::double))"
    return {
        "m1": order_score("1", "size"),
        "m2": order_score("2", "size"),
        "a1": f"case when size = 3 then sqrt(0.5::double) else {polynomial(LAST_WEIGHT, u)} - m1 / sqrt(mm) end",
        "a2": f"case when size > 5 then {polynomial(NEXT_WEIGHT, u)} - m2 / sqrt(mm) end",
        "inner_score": "case when size > 5 then mx - m1 * (x1 - y1) - m2 * (x2 - y2) when size > 3 then mx - m1 * (x1 - y1) else 0.0::double end",
        "scale": """case when size > 5 then (mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)
          when size > 3 then (mm - 2 * m1 * m1) / (1 - 2 * a1 * a1) else 1.0::double end""",
        "fit": "inner_score / sqrt(scale) + a1 * (y1 - x1) + coalesce(a2 * (y2 - x2), 0.0::double)",
    }


def statistic(table: DataFrame) -> DataFrame:
    """``w`` from the sums of a group: scores times values, squared scores, squared deviations, outer values."""
    enough = table.withColumn("known", (F.col("size") >= LEAST) & (F.col("varied") == 1.0) & (F.col("ss") > 0))
    lowest = F.expr(order_scores("array(1, 2)", "size"))
    enough = enough.withColumn("lowest", F.when(F.coalesce("known", F.lit(False)), lowest))
    for name, text in {**weight_steps(), "m1": "lowest[0]", "m2": "lowest[1]"}.items():
        enough = enough.withColumn(name, F.when(F.coalesce("known", F.lit(False)), F.expr(text)))
    w = F.least(F.lit(1.0), F.col("fit") * F.col("fit") / F.col("ss"))
    note = F.when(F.col("size") < LEAST, "too_few").when(~F.coalesce("known", F.lit(False)), "constant")
    return enough.withColumn("w", F.when(F.col("known"), w)).withColumn(
        "note", F.coalesce(note, F.when(F.col("size") > MOST_FOR_P, "beyond_5000"), F.lit(""))
    )


def p_values(table: DataFrame) -> DataFrame:
    """``p_value`` of ``w`` and ``n``: exact for 3 values, Royston's normalising transforms up to 5,000."""
    n = "(n::double)"
    gap = "ln(greatest(1.0::double - w, 1e-300::double))"
    bound = polynomial(SMALL_BOUND, n)
    z = f"""case when n <= 11 then case when {gap} >= {bound} then 40.0::double
        else (-ln({bound} - {gap}) - {polynomial(SMALL_MEAN, n)}) / exp({polynomial(SMALL_LOG_SPREAD, n)}) end
      else ({gap} - {polynomial(LARGE_MEAN, f'ln{n}')}) / exp({polynomial(LARGE_LOG_SPREAD, f'ln{n}')}) end"""
    used = (F.col("n") > LEAST) & (F.col("n") <= MOST_FOR_P) & F.col("w").isNotNull()
    scored = table.withColumn("z", F.when(used, F.expr(z)))
    upper = normal_two_sided("z") / 2
    tail = F.when(F.col("z") >= 0, upper).when(F.col("z") < 0, 1 - upper)
    three = 6 / F.lit(3.141592653589793) * (F.asin(F.sqrt("w")) - F.asin(F.sqrt(F.lit(0.75))))
    return scored.withColumn("p_value", F.when(F.col("n") == LEAST, F.greatest(F.lit(0.0), three)).otherwise(tail))
