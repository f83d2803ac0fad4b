"""Queries of scaling, model training, sinks and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass import adapters
from tallyglass.operators import cleaning, scaling, scoring, training
from tallyglass.plans import modelling
from tallyglass.registered import daily, quality, retrieval
from tallyglass.registered.common import CALENDAR, CLEAN, PRED, TX, present, r
from tallyglass.schema import MODEL_FEATURES, NUMERIC_COLUMNS, wide_transaction_schema
from tallyglass.sources import featurestore, sinks, transactions
from tallyglass.streaming import jobs
from tallyglass.workspace import scratch_path

SCALED = NUMERIC_COLUMNS
NTZ_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType() if f.name == "tx_datetime" else f.dataType, True)
        for f in wide_transaction_schema()
    ]
)


def _clean(spark, sf_dir):
    return cleaning.clean(adapters.transactions(spark, sf_dir))


def minmax_prev_day(spark, sf_dir):
    table = scaling.scale_by_previous_day(cleaning.with_day(_clean(spark, sf_dir)), SCALED)
    return present(table.select("transaction_id", "date", *[f"{c}_scaled" for c in SCALED]))


def minmax_prev_day_uncleaned(spark, sf_dir):
    """Statistics from cleaned rows, applied to the uncleaned day."""
    raw = cleaning.with_day(adapters.transactions(spark, sf_dir))
    table = scaling.scale_by_previous_day(cleaning.clean(raw), SCALED, current=scaling.complete_rows(raw, SCALED))
    return present(table.select("transaction_id", "date", *[f"{c}_scaled" for c in SCALED]))


def robust_prev_day(spark, sf_dir):
    table = scaling.scale_by_previous_day(cleaning.with_day(_clean(spark, sf_dir)), SCALED, method="robust")
    return present(table.select("transaction_id", "date", *[f"{c}_scaled" for c in SCALED]))


def standard_scaled(spark, sf_dir):
    table = scaling.scale_whole(_clean(spark, sf_dir), SCALED)
    return present(table.select("transaction_id", *[f"{c}_scaled" for c in SCALED]))


def assembled_rows(spark, sf_dir):
    kept = scaling.complete_rows(adapters.transactions(spark, sf_dir), ["tx_amount", "terminal_id"])
    return present(kept.select("transaction_id", "tx_amount", "terminal_id"))


def text_roundtrip_clean(spark, sf_dir):
    """Raw rows written as text files, read back with the fixed layout, cleaned."""
    path = scratch_path(spark, "raw-text")
    micro = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    adapters.transactions(spark, sf_dir).write.option("timestampNTZFormat", micro).csv(path)
    return present(cleaning.clean(transactions.read_transactions(spark, path, NTZ_SCHEMA)))


def daily_table_roundtrip(spark, sf_dir):
    """Cleaned rows in one folder per day, overwritten twice, one day read back through partition pruning."""
    path = scratch_path(spark, "days")
    rows = cleaning.with_day(_clean(spark, sf_dir))
    sinks.overwrite_days(rows, path)
    sinks.overwrite_days(rows.filter("date >= date'2024-01-15'"), path)
    return present(transactions.read_parquet(spark, path).groupBy("date").agg(F.count(F.lit(1)).alias("rows")))


def run_log(spark, sf_dir):
    table = scoring.evaluate(adapters.predictions(spark, sf_dir), ["model"], "weight")
    log = sinks.metric_rows(table, "nightly", ["auc", "accuracy", "f1"])
    return present(log.select("run_id", "run_name", "kind", "key", F.col("value").cast("double").alias("value")))


def materialized_latest(spark, sf_dir):
    """Two loads into the latest-row table, the later days first, then a merged read."""
    path = scratch_path(spark, "latest")
    stats = adapters.driver_stats(spark, sf_dir)
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    featurestore.upsert_latest(stats.filter(F.col("event_timestamp") >= cut), path, 0, ["driver_id"])
    return present(
        featurestore.materialize_latest(spark, stats.filter(F.col("event_timestamp") < cut), path, 1, ["driver_id"])
    )


def rf_holdout_metrics(spark, sf_dir):
    train, test = modelling.prepare(_clean(spark, sf_dir))
    model = training.build_pipeline(MODEL_FEATURES, "rf", "weight").fit(train)
    return present(training.evaluate_model(model, test, "rf", "transaction_id", "weight"))


def lr_holdout_metrics(spark, sf_dir):
    train, test = modelling.prepare(_clean(spark, sf_dir))
    model = training.build_pipeline(MODEL_FEATURES, "lr", "weight").fit(train)
    return present(training.evaluate_model(model, test, "lr", "transaction_id", "weight"))


def cv_leaderboard(spark, sf_dir):
    train, _ = modelling.prepare(_clean(spark, sf_dir))
    fitted = training.cross_validate(
        train, training.build_pipeline(MODEL_FEATURES, "rf", "weight"), "transaction_id", weight="weight", parallelism=8
    )
    return training.grid_results(spark, fitted).select("trial_id", F.to_json("params").alias("params"), "auc")


def search_trials(spark, sf_dir):
    train, test = modelling.prepare(_clean(spark, sf_dir))
    table = training.search(train, test, MODEL_FEATURES, "transaction_id", "weight", training.draw_trials())
    return table.withColumn("params", F.to_json("params"))


def _event_stream(spark, sf_dir):
    schema = adapters.read_table(spark, sf_dir, "events").schema
    return jobs.stream_files(spark, f"{sf_dir}/events*.parquet", schema, "parquet")


def stream_clean(spark, sf_dir):
    rows = adapters.transactions_from_events(_event_stream(spark, sf_dir))
    output = scratch_path(spark, "stream-clean")
    jobs.start_clean(rows, output, scratch_path(spark, "stream-clean-state")).awaitTermination()
    return present(spark.read.schema(rows.schema).parquet(output))


def stream_daily_profile(spark, sf_dir):
    rows = adapters.transactions_from_events(_event_stream(spark, sf_dir))
    stream = jobs.daily_profile(rows, NUMERIC_COLUMNS)
    table = jobs.run_to_table(stream, scratch_path(spark, "stream-profile"), scratch_path(spark, "stream-profile-state"))
    return present(table.drop("approx_distinct"))


def stream_without_repeats(spark, sf_dir):
    """Every event arrives twice; repeats inside the watermark vanish."""
    both = _event_stream(spark, sf_dir).unionByName(_event_stream(spark, sf_dir))
    stream = jobs.without_repeats(both, ["event_id"], "ts").select("event_id", "ts", "user_id", "value")
    return present(
        jobs.run_to_table(stream, scratch_path(spark, "stream-once"), scratch_path(spark, "stream-once-state"))
    )


def stream_online_upsert(spark, sf_dir):
    """Feature rows pushed in several micro-batches into the latest-row table."""
    source, latest = scratch_path(spark, "stats"), scratch_path(spark, "pushed")
    stats = adapters.driver_stats(spark, sf_dir)
    stats.repartition(4, "event_timestamp").write.parquet(source)
    stream = jobs.stream_files(spark, source, stats.schema, "parquet")
    jobs.push_features(stream, scratch_path(spark, "push-state"), ["driver_id"], latest=latest).awaitTermination()
    return present(featurestore.read_latest(spark, latest, ["driver_id"]))


QUERIES = {
    f.__name__: f
    for f in [
        minmax_prev_day,
        minmax_prev_day_uncleaned,
        robust_prev_day,
        standard_scaled,
        assembled_rows,
        text_roundtrip_clean,
        daily_table_roundtrip,
        run_log,
        materialized_latest,
        rf_holdout_metrics,
        lr_holdout_metrics,
        cv_leaderboard,
        search_trials,
        stream_clean,
        stream_daily_profile,
        stream_without_repeats,
        stream_online_upsert,
    ]
}


def _minmax_sql(current: str) -> str:
    stats = ", ".join(f"min({c})::double as {c}_a, max({c})::double as {c}_b" for c in SCALED)
    out = ", ".join(
        f"{r(f'case when {c}_b > {c}_a then ({c} - {c}_a) / ({c}_b - {c}_a) else 0.5::double end')} as {c}_scaled"
        for c in SCALED
    )
    return f"""with {CLEAN}, {CALENDAR}, stats as (select date, {stats} from cleaned group by date),
      raw as (select *, cast(tx_datetime as date) as date from tx where {' and '.join(f'{c} is not null' for c in SCALED)})
      select transaction_id, cast(t.date as varchar) as date, {out} from {current} t
      join cal on cal.date = t.date join stats on stats.date = cal.prev_date"""


ORACLE = {
    "minmax_prev_day": _minmax_sql("cleaned"),
    "minmax_prev_day_uncleaned": _minmax_sql("raw"),
    "robust_prev_day": f"""with {CLEAN}, {CALENDAR}, stats as (select date, {", ".join(f"quantile_disc({c}, 0.5)::double as {c}_m, (quantile_disc({c}, 0.75) - quantile_disc({c}, 0.25))::double as {c}_w" for c in SCALED)}
        from cleaned group by date)
      select transaction_id, cast(t.date as varchar) as date,
        {", ".join(f"{r(f'case when {c}_w > 0 then ({c} - {c}_m) / {c}_w else 0 end')} as {c}_scaled" for c in SCALED)}
      from cleaned t join cal on cal.date = t.date join stats on stats.date = cal.prev_date""",
    "standard_scaled": f"""with {CLEAN}, s as (select {", ".join(f"avg({c}) as {c}_m, stddev_samp({c}) as {c}_d" for c in SCALED)} from cleaned)
      select transaction_id, {", ".join(f"{r(f'({c} - {c}_m) / {c}_d')} as {c}_scaled" for c in SCALED)} from cleaned, s""",
    "assembled_rows": f"with {TX} select transaction_id, {r('tx_amount')} as tx_amount, terminal_id from tx "
    "where tx_amount is not null and terminal_id is not null",
    "text_roundtrip_clean": daily.ORACLE["clean_transactions"],
    "daily_table_roundtrip": f"""with {CLEAN} select cast(date as varchar) as date, count(*) as "rows" from cleaned group by date""",
    "run_log": f"""with {PRED}, {quality._area('preds', 'model', 'weight')}
      select model as run_id, 'nightly' as run_name, 'metric' as kind, key, {r('value')} as value from (
        select model, 'auc' as key, auc as value from area union all
        select model, 'accuracy', {quality._ACC} from area union all select model, 'f1', {quality._F1} from area)""",
    "materialized_latest": retrieval.ORACLE["latest_features"],
    "stream_clean": daily.ORACLE["clean_transactions"],
    "stream_daily_profile": f"""with {TX}, long as (
        {" union all ".join(f"select tx_datetime, '{c}' as feature, {c} as v from tx" for c in NUMERIC_COLUMNS)})
      select cast(cast(tx_datetime as date) as varchar) as date, feature, count(v) as "rows", {r('avg(v)')} as mean,
        {r('stddev_pop(v)')} as std, {r('min(v)')} as "min", {r('max(v)')} as "max"
      from long where v is not null
        and cast(tx_datetime as date) + interval 1 day <= (select max(ts) from events) - interval 1 day
      group by cast(tx_datetime as date), feature""",
    "stream_without_repeats": f"""select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, user_id,
      {r('value')} as value from events""",
    "stream_online_upsert": retrieval.ORACLE["latest_features"],
}
