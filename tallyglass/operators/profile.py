"""Column profiles by day: moments, quantiles, distinct values, correlations, day-over-day change."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions.numeric import as_numeric, finite, numeric_columns, ratio_or, unless_constant
from tallyglass.operators.ranks import SPLIT_ABOVE, cell_quantiles, value_cells
from tallyglass.workspace import materialize

# Names of the statistics in a profile row.
PROFILE_STATS = [
    "mean",
    "std",
    "min",
    "max",
    "median",
    "25percentile",
    "75percentile",
    "skewness",
    "kurtosis",
    "missing_ratio",
    "non_null_ratio",
    "duplicates_ratio",
]
QUARTILES = [0.25, 0.5, 0.75]
SKETCH_ACCURACY = 10000


def column_rows(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, code, value): one row per row and column, nulls kept; ``code`` indexes ``columns``.

    Aggregates over this form have one short set of states instead of one per column, which keeps the
    generated code small enough to be compiled well; the extra rows never leave the task.
    """
    cells = [F.struct(F.lit(i).alias("code"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)]
    return df.select(*by, F.explode(F.array(*cells)).alias("c")).select(*by, "c.*")


def moments(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Everything that merges, per group and column: one scan, one shuffle of small partial states."""
    varied = F.min("value") < F.max("value")
    table = column_rows(df, by, columns).groupBy(*by, "code").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("non_null"),
        F.avg("value").alias("mean"),
        unless_constant(F.stddev_pop("value"), "value").alias("std"),
        unless_constant(F.var_samp("value"), "value").alias("var"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.when(varied, finite(F.skewness("value"))).alias("skewness"),
        F.when(varied, finite(F.kurtosis("value"))).alias("kurtosis"),
    )
    return _named(table, by, columns)


def _sketches(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Approximate quartiles and distinct values of every column."""
    states = []
    for c in columns:
        distinct = F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("bigint"))
        q = F.percentile_approx(F.col(c).cast("double"), QUARTILES, SKETCH_ACCURACY)
        states.append(F.struct(F.lit(c).alias("column"), q.alias("q"), distinct.alias("distinct_values")).alias(c))
    wide = df.groupBy(*by).agg(*states)
    return wide.select(*by, F.explode(F.array(*columns)).alias("p")).select(*by, "p.*")


def _named(table: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in columns])
    rest = [c for c in table.columns if c not in {*by, "code"}]
    return table.select(*by, names[F.col("code")].alias("column"), *rest)


def distinct_counts(df: DataFrame, by: list[str], columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column, null counted as one value.

    Exact: repeated values collapse map-side and only distinct ones travel. Approximate: one sketch
    per column, no unpivot.
    """
    if approximate:
        sketches = [
            (F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("bigint"))).alias(c) for c in columns
        ]
        return df.groupBy(*by).agg(*sketches).unpivot(by, columns, "column", "distinct_values")
    cells = value_cells(df, by, columns)
    return _named(cells.groupBy(*by, "code").agg(F.count(F.lit(1)).alias("distinct_values")), by, columns)


def profile(
    df: DataFrame,
    by: list[str] | None = None,
    columns: list[str] | None = None,
    approximate: bool = False,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """One row per group and numeric column.

    ``non_null_ratio`` is the filled share; ``missing_ratio`` is its complement. Exact distinct values
    and quartiles come from one set of value cells, so a day that holds most of the table is spread
    over tasks; ``approximate`` takes sketches instead and shuffles only small states.
    """
    by = by or []
    columns = columns or [c for c in numeric_columns(df) if c not in by]
    source = as_numeric(df, columns)
    for key in by:
        source = source.filter(F.col(key).isNotNull())
    stats = moments(source, by, columns)
    if approximate:
        stats = stats.join(_sketches(source, by, columns), [*by, "column"])
    else:
        group = [*by, "code"]
        cells = materialize(value_cells(source, by, columns), "profile-cells")
        unique = cells.groupBy(*group).agg(F.count(F.lit(1)).alias("distinct_values"))
        quartiles = cell_quantiles(cells, group, QUARTILES, split_above)
        stats = stats.join(_named(unique.join(quartiles, group, "left"), by, columns), [*by, "column"])
    share = ratio_or(F.col("non_null"), F.col("rows"))
    return stats.select(
        *by,
        "column",
        "rows",
        "mean",
        "std",
        "min",
        "max",
        F.col("q")[1].alias("median"),
        F.col("q")[0].alias("25percentile"),
        F.col("q")[2].alias("75percentile"),
        "skewness",
        "kurtosis",
        (1 - share).alias("missing_ratio"),
        share.alias("non_null_ratio"),
        ratio_or(F.col("rows") - F.col("distinct_values"), F.col("rows")).alias("duplicates_ratio"),
    )


def profile_long(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Profile rows to (group, column, stat, value)."""
    return table.unpivot([*(by or []), "column"], PROFILE_STATS, "stat", "value")


def correlation(
    df: DataFrame, by: list[str] | None = None, columns: list[str] | None = None, digits: int | None = 3
) -> DataFrame:
    """Pearson matrix in long form (group, col_a, col_b, corr) after null -> 0; undefined is null.

    Each row becomes one row per left column, with the later columns beside it; the aggregate runs
    map-side and the shuffle carries one state row per task, group and column.
    Covariance over the two deviations, because ``corr`` raises on a constant column in ANSI mode.
    """
    by = by or []
    columns = columns or [c for c in numeric_columns(df) if c not in by]
    source = as_numeric(df, columns).fillna(0, subset=columns)
    right = range(1, len(columns))
    rows = [
        F.struct(
            F.lit(i).alias("code"),
            F.col(a).cast("double").alias("a"),
            *[(F.col(columns[j]) if j > i else F.lit(None)).cast("double").alias(f"b{j}") for j in right],
        )
        for i, a in enumerate(columns)
    ]
    states = source.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*").groupBy(*by, "code").agg(
        unless_constant(F.stddev_pop("a"), "a").alias("std"), *[F.covar_pop("a", f"b{j}").alias(f"c{j}") for j in right]
    )
    # One row per group: deviations and covariances of all columns, in the order of their codes.
    fields = F.struct("code", "std", F.array(*[F.col(f"c{j}") for j in right]).alias("cov"))
    matrix = states.groupBy(*by).agg(F.sort_array(F.collect_list(fields)).alias("m"))
    cells = [F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), F.lit(1.0).alias("corr")) for c in columns]
    for (i, a), (j, b) in combinations(enumerate(columns), 2):
        scale = F.col("m")[i]["std"] * F.col("m")[j]["std"]
        value = F.when(scale > 0, F.col("m")[i]["cov"][j - 1] / scale).alias("corr")
        cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), value))
        cells.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), value))
    out = matrix.filter(F.size("m") > 0).select(*by, F.explode(F.array(*cells)).alias("c")).select(*by, "c.*")
    return out if digits is None else out.withColumn("corr", F.bround("corr", digits))


def calendar(df: DataFrame, day: str = "date") -> DataFrame:
    """Each available day with the previous and the next available one (not calendar neighbours).

    The window has no partition key on purpose: its input is one row per day.
    """
    order = Window.orderBy(day)
    present = df.select(day).filter(F.col(day).isNotNull()).distinct()
    return present.select(
        day, F.lag(day).over(order).alias("prev_date"), F.lead(day).over(order).alias("next_date")
    )


def profile_change(table: DataFrame, day: str = "date") -> DataFrame:
    """Day-over-day change of every statistic of every column."""
    order = Window.partitionBy("column", "stat").orderBy(day)
    return (
        profile_long(table, [day])
        .withColumn("previous", F.lag("value").over(order))
        .withColumn("change", F.col("value") - F.col("previous"))
    )


def top_values(df: DataFrame, columns: list[str], k: int = 5, by: list[str] | None = None) -> DataFrame:
    """The ``k`` most frequent values of each column, as text; ties go to the smaller text.

    Counts are pre-aggregated per value; the ranked window only sees one row per distinct value and
    is cut to ``k`` per task before its shuffle.
    """
    by = by or []
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    counted = (
        df.select(*by, cells.alias("v"))
        .select(*by, "v.*")
        .filter("value is not null")
        .groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    order = Window.partitionBy(*by, "column").orderBy(F.desc("count"), "value")
    return counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def data_summary(
    df: DataFrame, by: list[str] | None = None, columns: list[str] | None = None, k: int = 5, approximate: bool = False
) -> DataFrame:
    """Profile of each column with its null count and its ``k`` most frequent values (array, best first)."""
    by = by or []
    columns = columns or [c for c in numeric_columns(df) if c not in by]
    table = profile(df, by, columns, approximate)
    common = top_values(df, columns, k, by).groupBy(*by, "column").agg(
        F.sort_array(F.collect_list(F.struct("rank", "value", "count"))).alias("top")
    )
    nulls = F.round(F.col("missing_ratio") * F.col("rows")).cast("bigint")
    return table.withColumn("null_count", nulls).join(common, [*by, "column"], "left")


def summary_against_reference(summary: DataFrame, days: DataFrame, day: str = "date") -> DataFrame:
    """Each day's summary beside that of the previous available day (``ref_`` columns)."""
    linked = summary.join(days.select(day, "prev_date"), day)
    kept = ["rows", "null_count", *PROFILE_STATS, "top"]
    before = summary.select(F.col(day).alias("prev_date"), "column", *[F.col(f"`{c}`").alias(f"ref_{c}") for c in kept])
    return linked.join(before, ["prev_date", "column"], "left")
