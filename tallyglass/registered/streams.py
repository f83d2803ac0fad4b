"""Queries of streams in several micro-batches: push log, keyed state, point-in-time features, file sequences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyglass import adapters
from tallyglass.registered import daily, learning, retrieval
from tallyglass.registered.common import STATS, present
from tallyglass.sources import featurestore, latesttable, pushlog
from tallyglass.streaming import jobs, state
from tallyglass.workspace import materialize, scratch_path

DAY = dt.timedelta(days=1)
RATES = ["conv_rate", "acc_rate", "avg_daily_trips"]
FRESH = 1  # days
AT_ONCE = {"processingTime": "0 seconds"}


def _push(spark, rows, label, slices=4, closing=False):
    """Rows pushed in the order of their time, in equal spans of time; ``closing`` adds a last row of a far year."""
    log = pushlog.PushLog(spark, scratch_path(spark, label))
    first, last = rows.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    span = (last - first) / slices
    for i in range(slices):
        at = F.col("event_timestamp")
        low, high = (F.lit(first + span * k) for k in (i, i + 1))
        part = rows.filter((at >= low) & (at < high if i + 1 < slices else at.isNotNull()))
        log.push(part, f"slice-{i}")
        log.push(part, f"slice-{i}")  # a producer that tries again
    if closing:
        known = {"event_timestamp": "9000-01-01", "driver_id": -1}  # a null key would be filtered ahead of the watermark
        end = spark.range(1).select(*[F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema])
        log.push(end, "closing")
    return log


def _stats_log(spark, sf_dir, closing=False):
    stats = materialize(adapters.driver_stats(spark, sf_dir), "pushed-stats")
    return _push(spark, stats, "push-stats", closing=closing), stats.schema


def stream_push_history(spark, sf_dir):
    """Feature rows from the push log, one push per micro-batch, into the history."""
    log, schema = _stats_log(spark, sf_dir)
    history = scratch_path(spark, "pushed-history")
    stream = pushlog.stream(spark, log.path, schema, segments=1)
    jobs.drain(jobs.push_features(stream, scratch_path(spark, "push-state"), ["driver_id"], history=history, trigger=AT_ONCE))
    return present(featurestore.read_history(spark, history))


def _newest(spark, sf_dir, ttl=None):
    log, schema = _stats_log(spark, sf_dir)
    stream = pushlog.stream(spark, log.path, schema, segments=1)
    checkpoint = scratch_path(spark, "newest-state")
    changes = state.newest_changes(stream, ["driver_id"], ttl=ttl)
    jobs.drain(state.start_changes(changes, checkpoint, lambda batch, number: batch.write.format("noop").mode("overwrite").save(), **AT_ONCE))
    return present(state.read_newest(spark, checkpoint))


def stream_latest_state(spark, sf_dir):
    """Newest feature row per driver, held as typed state over several micro-batches."""
    return _newest(spark, sf_dir)


def stream_latest_fresh(spark, sf_dir):
    """The same with a time-to-live: drivers whose newest row is too old have left the state."""
    return _newest(spark, sf_dir, FRESH * DAY)


def stream_asof_features(spark, sf_dir):
    """Point-in-time features of requests that arrive by push, from feature rows that arrive by push."""
    stats, schema = _stats_log(spark, sf_dir, closing=True)
    requests = materialize(adapters.feature_requests(spark, sf_dir), "pushed-requests")
    asked = _push(spark, requests, "push-requests", closing=True)
    joined = state.asof_stream(
        pushlog.stream(spark, asked.path, requests.schema, segments=1),
        pushlog.stream(spark, stats.path, schema, segments=1),
        ["driver_id"], ["event_id"], RATES, 2 * DAY,
    )
    table = jobs.run_to_table(joined, scratch_path(spark, "stream-asof"), scratch_path(spark, "stream-asof-state"), AT_ONCE)
    return present(table.filter("event_id is not null"), doubles=retrieval.TRIPS)


def latest_lookup(spark, sf_dir):
    """Three loads into the keyed latest-row table, the newest days first; all drivers are looked up, and as many unknown ones."""
    table = latesttable.LatestTable(spark, scratch_path(spark, "latest-table"), ("driver_id",))
    stats = materialize(adapters.driver_stats(spark, sf_dir), "stats")
    age = F.floor((F.dayofmonth("event_timestamp") - 1) / 11)
    for part in (2, 1, 0):
        table.load(stats.filter(age == part), f"part-{part}", rows_per_file=200)
        table.load(stats.filter(age == part), f"part-{part}", rows_per_file=200)  # tried again
    drivers = adapters.read_table(spark, sf_dir, "events").select(F.col("user_id").alias("driver_id")).distinct()
    asked = drivers.unionAll(drivers.select(F.col("driver_id") + 10_000_000))
    return present(table.lookup(asked))


def stream_clean_files(spark, sf_dir):
    """Raw text files, one per stretch of days, cleaned one file per micro-batch, in two runs."""
    raw, output, checkpoint = (scratch_path(spark, name) for name in ("raw-files", "clean-files", "clean-files-state"))
    rows = adapters.transactions(spark, sf_dir)
    part = F.coalesce(F.floor(F.dayofmonth("tx_datetime") / 8), F.lit(0)).cast("int")
    micro = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    for late in (False, True):
        chosen = rows.withColumn("_part", part).filter((F.col("_part") >= 2) if late else (F.col("_part") < 2))
        chosen.repartition("_part").drop("_part").write.mode("append").option("timestampNTZFormat", micro).csv(raw)
        cleaned = jobs.run_clean(spark, raw, output, checkpoint, learning.NTZ_SCHEMA)
    return present(cleaned)


QUERIES = {
    f.__name__: f
    for f in [stream_push_history, stream_latest_state, stream_latest_fresh, stream_asof_features, stream_clean_files, latest_lookup]
}

ORACLE = {
    "stream_push_history": retrieval.ORACLE["feature_dedup"],
    "stream_latest_state": retrieval.ORACLE["latest_features"],
    "stream_latest_fresh": f"""with {STATS} select {retrieval._STATS_OUT} from (select * from driver_stats
        qualify row_number() over (partition by driver_id order by event_timestamp desc, created desc) = 1)
      where event_timestamp + interval {FRESH} day > (select max(event_timestamp) - interval 1 day from driver_stats)""",
    "stream_asof_features": retrieval.ORACLE["asof_features"],
    "latest_lookup": retrieval.ORACLE["latest_features"],
    "stream_clean_files": daily.ORACLE["clean_transactions"],
}
