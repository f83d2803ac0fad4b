"""Queries of the feature layer: point-in-time joins, latest values, on-demand features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyglass import adapters
from tallyglass.operators import featureviews
from tallyglass.operators.asof import FeatureTable, asof_join, deduplicate, latest_per_key, validity_join
from tallyglass.registered.common import STATS, present, r, stamp
from tallyglass.workspace import materialize

DAY = dt.timedelta(days=1)
TRIPS = ("avg_daily_trips",)
RATES = ["conv_rate", "acc_rate", "avg_daily_trips"]


def _stats(spark, sf_dir):
    """The feature table, stored once: a join reads its sources several times."""
    return materialize(adapters.driver_stats(spark, sf_dir), "driver-stats")


def _catalog(spark, sf_dir):
    stats = _stats(spark, sf_dir)
    return featureviews.driver_catalog(stats, featureviews.with_productivity(stats))


def _versions(stats):
    """Every feature row twice: an early draft with halved rates and the final one, created later."""
    draft = stats.select(
        "driver_id",
        "event_timestamp",
        F.expr("created - interval 30 minutes").alias("created"),
        (F.col("conv_rate") / 2).alias("conv_rate"),
        (F.col("acc_rate") / 2).alias("acc_rate"),
        "avg_daily_trips",
    )
    return stats.unionByName(draft)


def asof_features(spark, sf_dir):
    requests = adapters.feature_requests(spark, sf_dir)
    table = FeatureTable(_stats(spark, sf_dir), {c: (c, 2 * DAY) for c in RATES})
    return present(asof_join(requests, [table], ["driver_id"]), doubles=TRIPS)


def asof_unbounded(spark, sf_dir):
    requests = adapters.feature_requests(spark, sf_dir)
    table = FeatureTable(_stats(spark, sf_dir), {c: (c, None) for c in RATES})
    return present(asof_join(requests, [table], ["driver_id"], bucket=3 * DAY), doubles=TRIPS)


def asof_created_ties(spark, sf_dir):
    requests = adapters.feature_requests(spark, sf_dir)
    table = FeatureTable(_versions(_stats(spark, sf_dir)), {c: (c, DAY) for c in RATES})
    return present(asof_join(requests, [table], ["driver_id"]), doubles=TRIPS)


def asof_range_join(spark, sf_dir):
    requests = adapters.feature_requests(spark, sf_dir)
    joined = validity_join(requests, _stats(spark, sf_dir), ["driver_id"], RATES, 2 * DAY, slot=DAY)
    return present(joined, doubles=TRIPS)


def feature_dedup(spark, sf_dir):
    rows = _versions(_stats(spark, sf_dir))
    return present(deduplicate(rows, ["driver_id"], "event_timestamp", "created"))


def multi_view_features(spark, sf_dir):
    names = [
        "driver_hourly_stats:avg_daily_trips",
        "driver_quality_metrics:conv_rate",
        "driver_quality_metrics:acc_rate",
        "driver_activity_rates_linear_combination_fv:linear_combination",
        "driver_productivity_metrics:productivity",
    ]
    table = _catalog(spark, sf_dir).historical(adapters.feature_requests(spark, sf_dir), names)
    return present(table, doubles=TRIPS)


def on_demand_linear(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    service = featureviews.driver_service(catalog)
    return present(catalog.historical(adapters.feature_requests(spark, sf_dir), service))


def productivity(spark, sf_dir):
    return present(featureviews.with_productivity(adapters.driver_stats(spark, sf_dir)))


def latest_features(spark, sf_dir):
    return present(latest_per_key(adapters.driver_stats(spark, sf_dir), ["driver_id"]))


def online_latest(spark, sf_dir):
    people = adapters.read_table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("driver_id")).agg(
        (F.count(F.lit(1)) / 8.0).alias("conv_rate_coef"), (F.max("value") / 64.0).alias("acc_rate_coef")
    )
    names = [
        "driver_quality_metrics:conv_rate",
        "driver_quality_metrics:acc_rate",
        "driver_activity_rates_linear_combination_fv:linear_combination",
        "driver_productivity_metrics:productivity",
    ]
    as_of = dt.datetime(2024, 1, 29, 12)
    return present(_catalog(spark, sf_dir).online(people, names, as_of))


def feature_catalog(spark, sf_dir):
    """Each view with the number of feature rows behind it."""
    stats = adapters.driver_stats(spark, sf_dir)
    catalog = featureviews.driver_catalog(stats, featureviews.with_productivity(stats))
    meta = catalog.describe(spark).groupBy("view", "entity", "join_keys", "ttl_seconds").agg(
        F.concat_ws(",", F.sort_array(F.collect_list("feature"))).alias("features"),
        F.max(F.col("online").cast("int")).alias("online"),
    )
    rows = stats.agg(F.count(F.lit(1)).alias("n"))
    return present(meta.withColumn("source_rows", rows.scalar()))


QUERIES = {
    f.__name__: f
    for f in [
        asof_features,
        asof_unbounded,
        asof_created_ties,
        asof_range_join,
        feature_dedup,
        multi_view_features,
        on_demand_linear,
        productivity,
        latest_features,
        online_latest,
        feature_catalog,
    ]
}

_REQ = f"""event_id, driver_id, {stamp('event_timestamp')} as event_timestamp,
  {r('conv_rate_coef')} as conv_rate_coef, {r('acc_rate_coef')} as acc_rate_coef"""
_RATES_OUT = f"{r('conv_rate')} as conv_rate, {r('acc_rate')} as acc_rate, avg_daily_trips"
_ASOF = """
asof_rows as (
  select q.*, f.event_timestamp as fts, f.conv_rate, f.acc_rate, f.avg_daily_trips,
         q.event_timestamp - f.event_timestamp as age
  from requests q asof left join driver_stats f
    on q.driver_id = f.driver_id and q.event_timestamp >= f.event_timestamp
)"""


def _asof_sql(days: int | None) -> str:
    keep = "true" if days is None else f"event_timestamp - fts <= interval {days} day"
    return f"""with {STATS}, {_ASOF}
      select {_REQ}, case when {keep} then {r('conv_rate')} end as conv_rate,
        case when {keep} then {r('acc_rate')} end as acc_rate,
        case when {keep} then avg_daily_trips::double end as avg_daily_trips from asof_rows"""


def _fresh(days: int, expression: str) -> str:
    return f"case when event_timestamp - fts <= interval {days} day then {expression} end"


_LINEAR = "conv_rate_coef * conv_rate + acc_rate_coef * acc_rate"
_STATS_OUT = f"""driver_id, {stamp('event_timestamp')} as event_timestamp, {stamp('created')} as created,
  {_RATES_OUT}"""

ORACLE = {
    "asof_features": _asof_sql(2),
    "asof_unbounded": _asof_sql(None),
    "asof_created_ties": _asof_sql(1),
    "asof_range_join": _asof_sql(2),
    "feature_dedup": f"with {STATS} select {_STATS_OUT} from driver_stats",
    "multi_view_features": f"""with {STATS}, {_ASOF} select {_REQ},
      {_fresh(1, 'avg_daily_trips::double')} as avg_daily_trips, {_fresh(2, r('conv_rate'))} as conv_rate,
      {_fresh(2, r('acc_rate'))} as acc_rate, {_fresh(2, r(_LINEAR))} as linear_combination,
      {_fresh(7, r('conv_rate * acc_rate * avg_daily_trips'))} as productivity from asof_rows""",
    "on_demand_linear": f"""with {STATS}, {_ASOF} select {_REQ}, {_fresh(2, r('conv_rate'))} as conv_rate,
      {_fresh(2, r('acc_rate'))} as acc_rate, {_fresh(2, r(_LINEAR))} as linear_combination from asof_rows""",
    "productivity": f"""with {STATS} select {_STATS_OUT},
      {r('conv_rate * acc_rate * avg_daily_trips')} as productivity from driver_stats""",
    "latest_features": f"""with {STATS} select {_STATS_OUT} from driver_stats
      qualify row_number() over (partition by driver_id order by event_timestamp desc, created desc) = 1""",
    "online_latest": f"""with {STATS}, people as (
        select user_id as driver_id, count(*) / 8.0::double as conv_rate_coef, max(value) / 64.0::double as acc_rate_coef
        from events group by user_id),
      newest as (select * from driver_stats where event_timestamp <= timestamp '2024-01-29 12:00:00'
        qualify row_number() over (partition by driver_id order by event_timestamp desc) = 1),
      j as (select p.*, timestamp '2024-01-29 12:00:00' as event_timestamp, n.event_timestamp as fts,
              n.conv_rate, n.acc_rate, n.avg_daily_trips
            from people p left join newest n on n.driver_id = p.driver_id)
      select driver_id, {r('conv_rate_coef')} as conv_rate_coef, {r('acc_rate_coef')} as acc_rate_coef,
        {_fresh(2, r('conv_rate'))} as conv_rate, {_fresh(2, r('acc_rate'))} as acc_rate,
        {_fresh(2, r(_LINEAR))} as linear_combination,
        {_fresh(7, r('conv_rate * acc_rate * avg_daily_trips'))} as productivity from j""",
    "feature_catalog": f"""with {STATS}, meta as (
        select * from (values
          ('driver_hourly_stats', 86400::bigint, 'acc_rate,avg_daily_trips,conv_rate'),
          ('driver_quality_metrics', 172800::bigint, 'acc_rate,conv_rate'),
          ('driver_productivity_metrics', 604800::bigint, 'productivity')) t("view", ttl_seconds, features))
      select "view", 'driver' as entity, 'driver_id' as join_keys, ttl_seconds, features, 1::bigint as online,
        (select count(*) from driver_stats) as source_rows from meta""",
}
