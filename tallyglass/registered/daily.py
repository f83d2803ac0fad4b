"""Queries over raw and cleaned transactions: cleaning, slices, backlog, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyglass import adapters
from tallyglass.operators import cleaning, profile
from tallyglass.registered.common import CALENDAR, CLEAN, TX, present, r, stamp, unpivot_sql
from tallyglass.schema import NUMERIC_COLUMNS, TARGET_COLUMNS
from tallyglass.sources import backlog, transactions
from tallyglass.workspace import materialize

FEATURES = NUMERIC_COLUMNS


def _tx(spark, sf_dir):
    return adapters.transactions(spark, sf_dir)


def _clean(spark, sf_dir):
    return cleaning.clean(_tx(spark, sf_dir))


def _clean_by_day(spark, sf_dir):
    return cleaning.with_day(_clean(spark, sf_dir))


def clean_transactions(spark, sf_dir):
    return present(_clean(spark, sf_dir))


def clean_reject_counts(spark, sf_dir):
    return present(cleaning.reject_share(_tx(spark, sf_dir)))


def daily_slices(spark, sf_dir):
    rows = cleaning.with_day(_tx(spark, sf_dir)).groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("tx_amount").alias("amount")
    )
    return present(rows.filter("date is not null"))


def one_day_slice(spark, sf_dir):
    events = adapters.read_table(spark, sf_dir, "events")
    return present(cleaning.day_slice(adapters.timed_transactions(events), "2024-01-15"))


def available_days(spark, sf_dir):
    return present(cleaning.days(_tx(spark, sf_dir)))


def parsed_times(spark, sf_dir):
    """Times through text; those of error events are broken on purpose and come back null."""
    text = F.when(F.col("event_type") == "error", F.lit("24:61")).otherwise(F.col("ts").cast("string"))
    rows = adapters.read_table(spark, sf_dir, "events").select("event_id", text.alias("tx_datetime"))
    return present(transactions.parse_time(rows))


def _keys(spark, sf_dir):
    """Input keys: one per day. Processed keys: days with at least 65 error events (leaves gaps)."""
    events = adapters.read_table(spark, sf_dir, "events")
    per_day = events.groupBy(backlog.dated_name(F.col("ts")).alias("key")).agg(
        F.count_if(F.col("event_type") == "error").alias("errors"), F.count(F.lit(1)).alias("rows")
    )
    done = per_day.filter("errors * 5 > rows and key < '20240120'").select("key")
    return per_day.select("key"), done


def next_unprocessed(spark, sf_dir):
    return backlog.next_unprocessed(*_keys(spark, sf_dir))


def unprocessed_backfill(spark, sf_dir):
    return backlog.unprocessed(*_keys(spark, sf_dir))


def profile_daily(spark, sf_dir):
    return present(profile.profile(cleaning.with_day(_tx(spark, sf_dir)), ["date"], FEATURES))


def profile_total(spark, sf_dir):
    return present(profile.profile(_tx(spark, sf_dir), [], FEATURES))


def profile_delta(spark, sf_dir):
    table = profile.profile(_clean_by_day(spark, sf_dir), ["date"], FEATURES)
    return present(profile.profile_change(table))


def null_counts(spark, sf_dir):
    return present(cleaning.null_counts(_tx(spark, sf_dir)))


def duplicates_ratio(spark, sf_dir):
    table = profile.distinct_counts(cleaning.with_day(_tx(spark, sf_dir)), ["date"], FEATURES)
    return present(table)


def correlation_long(spark, sf_dir):
    return present(profile.correlation(cleaning.with_day(_tx(spark, sf_dir)), ["date"], FEATURES, None))


def correlation_total(spark, sf_dir):
    filled = cleaning.fill_numeric_nulls(_tx(spark, sf_dir), ["tx_amount"])
    return present(profile.correlation(filled, [], FEATURES, 3))


def reference_day_pairs(spark, sf_dir):
    return present(profile.calendar(_clean_by_day(spark, sf_dir)))


def data_summary(spark, sf_dir):
    table = profile.top_values(_clean_by_day(spark, sf_dir), FEATURES, 3, ["date"])
    return present(table)


def column_summary(spark, sf_dir):
    rows = _clean_by_day(spark, sf_dir)
    summary = materialize(profile.data_summary(rows, ["date"], FEATURES, 2), "summary")
    table = profile.summary_against_reference(summary, profile.calendar(rows))
    first = [F.get(f"{side}top", F.lit(0))["value"].alias(f"{side}top_value") for side in ("", "ref_")]
    second = F.get("top", F.lit(1))["count"].alias("second_count")
    out = table.select("date", "column", "rows", "null_count", "mean", "ref_rows", "ref_mean", *first, second)
    return present(out, doubles=("ref_rows", "second_count"))


def outlier_fences(spark, sf_dir):
    return present(cleaning.iqr_fences(_clean_by_day(spark, sf_dir), FEATURES))


def without_outliers(spark, sf_dir):
    kept = cleaning.drop_outliers(_clean_by_day(spark, sf_dir), FENCED)
    return present(kept.select("transaction_id", "date", "tx_amount"))


def pseudonymised_ids(spark, sf_dir):
    out = cleaning.pseudonymise(_clean(spark, sf_dir), ["customer_id", "terminal_id"], "s1-")
    return present(out.select("transaction_id", "customer_id", "terminal_id"))


QUERIES = {
    f.__name__: f
    for f in [
        clean_transactions,
        clean_reject_counts,
        daily_slices,
        one_day_slice,
        available_days,
        parsed_times,
        next_unprocessed,
        unprocessed_backfill,
        profile_daily,
        profile_total,
        profile_delta,
        null_counts,
        duplicates_ratio,
        correlation_long,
        correlation_total,
        reference_day_pairs,
        data_summary,
        column_summary,
        outlier_fences,
        without_outliers,
        pseudonymised_ids,
    ]
}

_TX_OUT = f"""transaction_id, {stamp('tx_datetime')} as tx_datetime, customer_id, terminal_id,
  {r('tx_amount')} as tx_amount, tx_time_seconds, tx_time_days,
  cast(tx_fraud as bigint) as tx_fraud, cast(tx_fraud_scenario as bigint) as tx_fraud_scenario"""

_TEXTS = " union all ".join(
    f"select date, '{c}' as \"column\", cast({c} as varchar) as value from cleaned" for c in NUMERIC_COLUMNS
)
# Outliers are cut by what can be a feature; labels have no fences.
FENCED = [c for c in NUMERIC_COLUMNS if c not in TARGET_COLUMNS]
_COLUMNS = ["tx_datetime", *NUMERIC_COLUMNS]
_DONE = """
per_day as (select strftime(ts, '%Y%m%d') as key, count(*) as n,
                   count(*) filter (where event_type = 'error') as errors from events group by 1),
done as (select key from per_day where errors * 5 > n and key < '20240120')"""


def _profile_sql(source: str, ctes: str, by: str, columns: list[str] | None = None) -> str:
    keys = f"{by}, " if by else ""
    on = "l.\"column\" = c.\"column\"" + (f" and l.{by} = c.{by}" if by else "")
    return f"""with {ctes}, long as ({unpivot_sql(source, by, columns)}),
centre as (select {keys}"column", avg(v) as m, var_pop(v) as s2 from long group by {keys}"column"),
prof as (
select {f'l.{by},' if by else ''} l."column", count(*) as "rows", avg(v) as mean, stddev_pop(v) as std,
  min(v) as "min", max(v) as "max", quantile_disc(v, 0.5) as median,
  quantile_disc(v, 0.25) as "25percentile", quantile_disc(v, 0.75) as "75percentile",
  case when any_value(s2) > 0 then avg((v - m) ** 3) / any_value(s2) ** 1.5 end as skewness,
  case when any_value(s2) > 0 then avg((v - m) ** 4) / any_value(s2) ** 2 - 3 end as kurtosis,
  1 - count(v) / count(*) as missing_ratio, count(v) / count(*) as non_null_ratio,
  (count(*) - count(distinct v) - max(case when v is null then 1 else 0 end)) / count(*) as duplicates_ratio
from long l join centre c on {on}
group by {f'l.{by},' if by else ''} l."column")"""


_STATS = [
    "mean", "std", "min", "max", "median", "25percentile", "75percentile", "skewness", "kurtosis",
    "missing_ratio", "non_null_ratio", "duplicates_ratio",
]
_PROFILE_OUT = '"column", "rows", ' + ", ".join(f'{r(chr(34) + s + chr(34))} as "{s}"' for s in _STATS)
_RAW_DAY = TX + ", raw as (select *, cast(tx_datetime as date) as date from tx)"


def _correlation_sql(ctes: str, source: str, by: str, digits: int) -> str:
    keys = f"{by}, " if by else ""
    group = f"group by {by}" if by else ""
    parts = []
    for a in NUMERIC_COLUMNS:
        for b in NUMERIC_COLUMNS:
            x, y = (f"coalesce({c}, 0)::double" for c in (a, b))
            value = "case when count(*) > 0 then 1.0::double end" if a == b else (
                f"case when var_pop({x}) > 0 and var_pop({y}) > 0 then corr({x}, {y}) end"
            )
            parts.append(
                f"select {keys}'{a}' as col_a, '{b}' as col_b, {value} as corr from {source} {group}"
            )
    day = "cast(date as varchar) as date, " if by else ""
    return f"with {ctes}, cells as ({' union all '.join(parts)}) select {day}col_a, col_b, {r('corr', digits)} as corr from cells"


ORACLE = {
    "clean_transactions": f"with {CLEAN} select {_TX_OUT} from cleaned",
    "clean_reject_counts": f"""with {TX}, flags as (
      select coalesce(transaction_id > 0 and customer_id > 0 and terminal_id > 0 and tx_amount > 0, false) as ok,
        coalesce({", ".join(f"cast({c} as varchar)" for c in _COLUMNS)}) is null as blank,
        {" or ".join(f"{c} is null" for c in _COLUMNS)} as holes
      from tx)
      select count(*) as total, count(*) filter (where blank) as all_null,
        count(*) filter (where not blank and not ok) as not_positive,
        count(*) filter (where not blank and ok and holes) as some_null, count(*) filter (where ok and not holes) as clean,
        {r('count(*) filter (where ok and not holes) / count(*)')} as clean_share from flags""",
    "daily_slices": f"""with {_RAW_DAY} select cast(date as varchar) as date, count(*) as "rows",
      {r('sum(tx_amount)')} as amount from raw where date is not null group by date""",
    "one_day_slice": f"with {_RAW_DAY} select {_TX_OUT} from raw where date = date '2024-01-15'",
    "available_days": "select distinct cast(cast(ts as date) as varchar) as date from events",
    "parsed_times": f"""select event_id, case when event_type <> 'error' then {stamp('ts')} end as tx_datetime
      from events""",
    "next_unprocessed": f"""with {_DONE} select key from per_day
      where key > coalesce((select max(key) from done), '') order by key limit 1""",
    "unprocessed_backfill": f"with {_DONE} select key from per_day where key not in (select key from done)",
    "profile_daily": _profile_sql("raw", _RAW_DAY, "date")
    + f" select cast(date as varchar) as date, {_PROFILE_OUT} from prof",
    "profile_total": _profile_sql("tx", TX, "") + f" select {_PROFILE_OUT} from prof",
    "profile_delta": _profile_sql("cleaned", CLEAN, "date")
    + ", melted as ("
    + " union all ".join(f"select date, \"column\", '{s}' as stat, \"{s}\" as value from prof" for s in _STATS)
    + f"""), lagged as (select *, lag(value) over (partition by "column", stat order by date) as previous from melted)
      select cast(date as varchar) as date, "column", stat, {r('value')} as value, {r('previous')} as previous,
        {r('value - previous')} as change from lagged""",
    "null_counts": "with "
    + TX
    + " "
    + " union all ".join(
        f"select '{c}' as \"column\", count(*) - count({c}) as null_count from tx"
        for c in ["transaction_id", "tx_datetime", *NUMERIC_COLUMNS[1:]]
    ),
    "duplicates_ratio": f"""with {_RAW_DAY}, long as ({unpivot_sql('raw', 'date')})
      select cast(date as varchar) as date, "column",
        count(distinct v) + max(case when v is null then 1 else 0 end) as distinct_values
      from long group by all""",
    "correlation_long": _correlation_sql(_RAW_DAY, "raw", "date", 6),
    "correlation_total": _correlation_sql(TX, "tx", "", 3),
    "reference_day_pairs": f"""with {CLEAN}, {CALENDAR} select cast(date as varchar) as date,
      cast(prev_date as varchar) as prev_date, cast(next_date as varchar) as next_date from cal""",
    "data_summary": f"""with {CLEAN}, long as ({_TEXTS}),
      counted as (select date, "column", value, count(*) as "count" from long group by all),
      ranked as (select *, row_number() over (partition by date, "column" order by "count" desc, value) as "rank"
                 from counted)
      select cast(date as varchar) as date, "column", value, "count", "rank" from ranked where "rank" <= 3""",
    "column_summary": f"""with {CLEAN}, {CALENDAR}, long as (
        {unpivot_sql('cleaned', 'date')}),
      txt as ({_TEXTS}),
      counted as (select date, "column", value, count(*) as n from txt group by all),
      ranked as (select *, row_number() over (partition by date, "column" order by n desc, value) as k from counted),
      s as (select l.date, l."column", count(*) as "rows", count(*) - count(v) as null_count, avg(v) as mean,
          (select value from ranked r where r.date = l.date and r."column" = l."column" and k = 1) as top_value,
          (select n from ranked r where r.date = l.date and r."column" = l."column" and k = 2) as second_count
        from long l group by l.date, l."column")
      select cast(a.date as varchar) as date, a."column", a."rows", a.null_count, {r('a.mean')} as mean,
        b."rows"::double as ref_rows, {r('b.mean')} as ref_mean, a.top_value, b.top_value as ref_top_value, a.second_count::double as second_count
      from s a join cal on cal.date = a.date left join s b on b.date = cal.prev_date and a."column" = b."column"
      """,
    "outlier_fences": f"""with {CLEAN}, long as ({unpivot_sql('cleaned', 'date')}),
      q as (select date, "column", quantile_disc(v, 0.25) as a, quantile_disc(v, 0.75) as b from long group by all)
      select cast(date as varchar) as date, "column", {r('a - 1.5::double * (b - a)')} as low,
        {r('b + 1.5::double * (b - a)')} as high from q""",
    "without_outliers": f"""with {CLEAN}, q as (select date,
        {", ".join(f"quantile_disc({c}, 0.25)::double as {c}_a, quantile_disc({c}, 0.75)::double as {c}_b" for c in FENCED)}
        from cleaned group by date)
      select transaction_id, cast(c.date as varchar) as date, {r('tx_amount')} as tx_amount
      from cleaned c join q on q.date = c.date
      where {" and ".join(f"{c} between {c}_a - 1.5::double * ({c}_b - {c}_a) and {c}_b + 1.5::double * ({c}_b - {c}_a)" for c in FENCED)}""",
    "pseudonymised_ids": f"""with {CLEAN} select transaction_id, sha256('s1-' || customer_id) as customer_id,
      sha256('s1-' || terminal_id) as terminal_id from cleaned""",
}
