"""Shared pieces of the registered queries: output formatting and the derived tables in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.schema import NUMERIC_COLUMNS

DIGITS = 6


def present(df: DataFrame, digits: int = DIGITS, doubles: tuple[str, ...] = ()) -> DataFrame:
    """Engine-neutral output: rounded doubles without negative zero, dates and times as text.

    ``doubles`` names whole-number columns that may be null; they leave as doubles.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in doubles:
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expression: str, digits: int = DIGITS) -> str:
    """SQL side of ``present`` for doubles."""
    return f"round(cast({expression} as double), {digits}) + 0.0"


def stamp(expression: str) -> str:
    """SQL side of ``present`` for timestamps."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


# Derived tables for the SQL side.
TX = """
tx_rows as (
  select event_id, event_id + 1 as transaction_id, case when event_id % 83 = 11 then null else ts end as tx_datetime,
         case when event_id % 89 = 13 then null else user_id end as customer_id,
         event_id % 97 as terminal_id,
         case when event_id % 50 = 7 then null when event_id % 41 = 3 then -value else value end as tx_amount,
         date_sub('second', timestamp '2024-01-01', ts) as tx_time_seconds,
         date_diff('day', date '2024-01-01', cast(ts as date)) as tx_time_days,
         case when event_id % 79 = 17 then null when value > 150 then 1
           when event_type = 'error' and event_id % 13 = 0 then 1 else 0 end as tx_fraud,
         case when value > 150 then 1 when event_type = 'error' and event_id % 13 = 0 then 2 else 0 end
           as tx_fraud_scenario
  from events
),
tx as (
  select * exclude (event_id) from tx_rows where event_id % 101 <> 19
  union all
  select null, null, null, null, null, null, null, null, null from tx_rows where event_id % 101 = 19
)"""
CLEAN = (
    TX
    + """,
cleaned as (
  select *, cast(tx_datetime as date) as date from tx
  where transaction_id > 0 and customer_id > 0 and terminal_id > 0 and tx_amount > 0
    and tx_datetime is not null and tx_time_seconds is not null and tx_time_days is not null
    and tx_fraud is not null and tx_fraud_scenario is not null
)"""
)
CALENDAR = """
cal as (
  select date, lag(date) over (order by date) as prev_date, lead(date) over (order by date) as next_date
  from (select distinct date from cleaned)
)"""
HASH32 = "('0x' || substr(md5({0}), 1, 8))::bigint"
PRED = f"""
base as (
  select event_id as key, ts, value as amount,
         case when value > 150 then 1 when event_type = 'error' and event_id % 13 = 0 then 1 else 0 end as label,
         value / 500.0 as baseline,
         {HASH32.format("'cand-' || event_id")} / 4294967296.0::double as noise
  from events
),
two as (
  select *, 0.6::double * baseline
    + 0.4::double * case when label = 1 then least(1.0::double, noise + 0.3::double) else noise end as candidate
  from base
),
preds as (
  select 'baseline' as model, key, ts, label, case when label = 1 then 10.0::double else 1.0::double end as weight,
         baseline as score, case when baseline >= 0.2::double then 1 else 0 end as prediction, amount from two
  union all
  select 'candidate', key, ts, label, case when label = 1 then 10.0::double else 1.0::double end,
         candidate, case when candidate >= 0.4::double then 1 else 0 end, amount from two
)"""
STATS = """
driver_stats as (
  select user_id as driver_id, cast(cast(ts as date) as timestamp) + interval 1 day as event_timestamp,
         cast(cast(ts as date) as timestamp) + interval 25 hours as created,
         avg(case when event_type = 'purchase' then 1.0::double else 0.0::double end) as conv_rate,
         1 - avg(case when event_type = 'error' then 1.0::double else 0.0::double end) as acc_rate,
         count(*) as avg_daily_trips
  from events group by user_id, cast(ts as date)
),
requests as (
  select event_id, user_id as driver_id, ts as event_timestamp,
         cast(event_id % 7 as double) / 2 as conv_rate_coef, cast(event_id % 5 as double) / 4 as acc_rate_coef
  from events where event_type = 'signup'
)"""


def unpivot_sql(table: str, keys: str, columns: list[str] | None = None) -> str:
    """(keys, column, v) from a wide table, nulls kept."""
    prefix = f"{keys}, " if keys else ""
    return " union all ".join(
        f"select {prefix}'{c}' as \"column\", cast({c} as double) as v from {table}"
        for c in columns or NUMERIC_COLUMNS
    )
