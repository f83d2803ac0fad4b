"""Queries of mergeable states: roll-ups of stored day states, frequent values by counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyglass import adapters
from tallyglass.operators import cleaning, daystates, heavyhitters, profile
from tallyglass.registered import daily
from tallyglass.registered.common import CLEAN, TX, present, r, unpivot_sql
from tallyglass.schema import NUMERIC_COLUMNS
from tallyglass.streaming import jobs
from tallyglass.workspace import checked_broadcast, materialize, scratch_path

CAPACITY = 500


def _raw_by_day(spark, sf_dir):
    return cleaning.with_day(adapters.transactions(spark, sf_dir)).filter("date is not null")


def _checked(states, rows, by):
    """Exact parts of the states, and whether the sketched parts keep their error bounds against all rows."""
    told = checked_broadcast(daystates.summary(states), "told")
    cells = profile.column_rows(rows, by, NUMERIC_COLUMNS)
    names = F.array(*[F.lit(c) for c in NUMERIC_COLUMNS])
    values = cells.select(*by, names[F.col("code")].alias("column"), "value").filter("value is not null")
    seen = values.join(told.select(*by, "column", "q"), [*by, "column"]).groupBy(*by, "column")
    ranks = [
        F.avg((F.col("value") < F.col("q")[i]).cast("double")).alias(f"below{i}") for i in range(3)
    ] + [F.avg((F.col("value") <= F.col("q")[i]).cast("double")).alias(f"upto{i}") for i in range(3)]
    exact = seen.agg(F.count_distinct("value").alias("exact"), *ranks)
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * daystates.DISTINCT_ERROR)
    inside = F.lit(True)
    for i, p in enumerate(daystates.QUARTILES):
        inside &= (F.col(f"below{i}") <= p + daystates.RANK_ERROR) & (F.col(f"upto{i}") >= p - daystates.RANK_ERROR)
    table = told.join(exact, [*by, "column"])
    return table.select(
        *by, "column", "rows", "non_null", "mean", "std", "min", "max",
        near.cast("bigint").alias("distinct_ok"), inside.cast("bigint").alias("quantiles_ok"),
    )


def _stored_states(spark, sf_dir):
    path = scratch_path(spark, "day-states")
    daystates.store(daystates.day_states(_raw_by_day(spark, sf_dir), NUMERIC_COLUMNS), path)
    return daystates.stored(spark, path)


def weekly_states(spark, sf_dir):
    """Weeks from stored day states."""
    weeks = materialize(daystates.roll_up(_stored_states(spark, sf_dir), "week"), "week-states")
    rows = _raw_by_day(spark, sf_dir).withColumn("date", F.trunc("date", "week"))
    return present(_checked(weeks, rows, ["date"]))


def total_states(spark, sf_dir):
    """The total of each column from months that were rolled up from days."""
    months = materialize(daystates.roll_up(_stored_states(spark, sf_dir), "month"), "month-states")
    total = materialize(daystates.merge(months.select("date", "column", *daystates.STATE_COLUMNS), []), "total-states")
    return present(_checked(total, _raw_by_day(spark, sf_dir), []))


def stream_week_states(spark, sf_dir):
    """The same weeks from day states that a stream has written as its days closed."""
    schema = adapters.read_table(spark, sf_dir, "events").schema
    events = jobs.stream_files(spark, f"{sf_dir}/events*.parquet", schema, "parquet")
    rows = adapters.transactions_from_events(events)
    stream = jobs.daily_states(rows, NUMERIC_COLUMNS)
    days = jobs.run_to_table(stream, scratch_path(spark, "stream-states"), scratch_path(spark, "stream-states-state"))
    weeks = materialize(daystates.roll_up(days, "week"), "stream-week-states")
    closed = days.select("date").distinct()
    kept = _raw_by_day(spark, sf_dir).join(checked_broadcast(closed, "closed-days"), "date", "left_semi")
    return present(_checked(weeks, kept.withColumn("date", F.trunc("date", "week")), ["date"]))


def frequent_values(spark, sf_dir):
    """The most frequent values of each column of all transactions; keys are flat, labels and hours are not."""
    rows = cleaning.clean(adapters.transactions(spark, sf_dir)).withColumn("hour", F.hour("tx_datetime"))
    return present(heavyhitters.frequent_values(rows, [*NUMERIC_COLUMNS, "hour"], 5, [], CAPACITY))


def frequent_values_by_day(spark, sf_dir):
    rows = cleaning.with_day(cleaning.clean(adapters.transactions(spark, sf_dir)))
    return present(heavyhitters.frequent_values(rows, NUMERIC_COLUMNS, 3, ["date"], 50))


QUERIES = {
    f.__name__: f
    for f in [weekly_states, total_states, stream_week_states, frequent_values, frequent_values_by_day]
}

_FACTS = f"""count(*) as "rows", count(v) as non_null, {r('avg(v)')} as mean, {r('stddev_pop(v)')} as std,
  {r('min(v)')} as "min", {r('max(v)')} as "max", 1::bigint as distinct_ok, 1::bigint as quantiles_ok"""
_RAW = f"{TX}, raw as (select *, cast(tx_datetime as date) as date from tx where tx_datetime is not null)"
_WEEKS = f"""long as ({unpivot_sql('raw', "cast(date_trunc('week', date) as date) as date")})
  select cast(date as varchar) as date, "column", {_FACTS} from long group by date, "column" """

ORACLE = {
    "weekly_states": f"with {_RAW}, {_WEEKS}",
    "total_states": f"""with {_RAW}, long as ({unpivot_sql('raw', '')}) select "column", {_FACTS} from long group by "column" """,
    # The last day is open: the watermark, a day behind the newest row, has not passed its end.
    "stream_week_states": f"""with {TX}, whole as (select *, cast(tx_datetime as date) as date from tx where tx_datetime is not null),
      raw as (select * from whole where date + interval 1 day <= (select max(tx_datetime) - interval 1 day from whole)), {_WEEKS}""",
    "frequent_values": f"""with {CLEAN}, long as ({" union all ".join(
        f"select '{c}' as col, cast({e} as varchar) as value from cleaned" for c, e in [*((c, c) for c in NUMERIC_COLUMNS), ("hour", "hour(tx_datetime)")])}),
      counted as (select col as "column", value, count(*) as "count" from long where value is not null group by all)
      select "column", value, "count", row_number() over (partition by "column" order by "count" desc, value) as "rank" from counted
      qualify "rank" <= 5""",
    "frequent_values_by_day": daily.ORACLE["data_summary"],
}
