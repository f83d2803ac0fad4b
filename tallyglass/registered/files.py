"""Queries of files: raw text with keys and broken lines, listings, reports read back, derived sources, tagged text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tallyglass import adapters
from tallyglass.functions.numeric import as_numeric, numeric_columns
from tallyglass.operators import cleaning, featureviews, profile
from tallyglass.registered import daily, learning, retrieval
from tallyglass.registered.common import TX, present, r
from tallyglass.schema import NUMERIC_COLUMNS
from tallyglass.sources import backlog, featurestore, sinks, transactions
from tallyglass.workspace import materialize, scratch_path

MICRO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _raw_files(spark, sf_dir):
    """Raw rows as text, a folder per day under its dated name; rows without a time under ``none``."""
    path = scratch_path(spark, "raw-by-day")
    rows = adapters.transactions(spark, sf_dir)
    key = F.coalesce(backlog.dated_name(F.col("tx_datetime")), F.lit("none"))
    rows.withColumn("key", key).repartition("key").write.partitionBy("key").option("timestampNTZFormat", MICRO).csv(path)
    return path


def rows_by_file(spark, sf_dir):
    """Rows with the key of their file, against the listing of the files: every file is listed, every row has one."""
    path = _raw_files(spark, sf_dir)
    keyed = transactions.read_with_file_key(spark, f"{path}/*", learning.NTZ_SCHEMA)
    counted = keyed.groupBy("file_key", F.to_date("tx_datetime").alias("date")).agg(F.count(F.lit(1)).alias("rows"))
    # One writing task may serve several days, so the stem of a file may stand for several.
    listed = transactions.list_files(spark, f"{path}/*").groupBy(F.col("key").alias("file_key")).agg(F.sum("length").alias("bytes"))
    table = counted.join(listed, "file_key", "left").groupBy("date").agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("bytes").isNull()).alias("unlisted")
    )
    return present(table)


def dated_slices(spark, sf_dir):
    """One day read through its dated folder name."""
    path = _raw_files(spark, sf_dir)
    rows = transactions.read_transactions(spark, f"{path}/key=20240115", learning.NTZ_SCHEMA)
    return present(rows.select("transaction_id", "tx_datetime", "tx_amount"))


def corrupt_rows(spark, sf_dir):
    """Broken lines among raw text keep their text; the others parse."""
    path = scratch_path(spark, "raw-broken")
    rows = adapters.read_table(spark, sf_dir, "events")
    line = F.concat_ws(",", "event_id", F.date_format("ts", MICRO), "user_id", "event_id", "value", F.lit("1"), F.lit("2"), F.lit("0"), F.lit("0"))
    broken = F.concat(F.lit("x"), F.col("event_id").cast("string"), F.lit(";broken"))
    rows.select(F.when(F.col("event_id") % 97 == 5, broken).otherwise(line).alias("value")).write.text(path)
    read = transactions.read_transactions(spark, path, learning.NTZ_SCHEMA, keep_corrupt=True)
    return present(read.select("transaction_id", "customer_id", "tx_amount", F.col(transactions.CORRUPT).alias("broken")))


def profile_reports(spark, sf_dir):
    """Daily profiles written as JSON reports, one folder per day, and read back."""
    path = scratch_path(spark, "profile-reports")
    table = profile.profile(cleaning.with_day(adapters.transactions(spark, sf_dir)), ["date"], NUMERIC_COLUMNS)
    sinks.write_profile(table, path)
    return present(spark.read.schema(table.schema).json(path))


def correlation_reports(spark, sf_dir):
    """Daily correlations written as JSON reports and read back; the days before the cut are written twice."""
    path = scratch_path(spark, "correlation-reports")
    rows = cleaning.with_day(adapters.transactions(spark, sf_dir))
    table = materialize(profile.correlation(rows, ["date"], NUMERIC_COLUMNS, None), "correlation")
    sinks.write_correlation(table, path)
    sinks.write_correlation(table.filter("date < date'2024-01-10'"), path)
    back = spark.read.schema(table.schema).json(path)
    undated = table.filter("date is null")
    return present(back.filter("date is not null").unionByName(undated))


def derived_source(spark, sf_dir):
    """A source that is derived when it is absent, and left as it is the second time."""
    path = scratch_path(spark, "derived")
    stats = materialize(adapters.driver_stats(spark, sf_dir), "stats")
    featurestore.derive_if_absent(stats, featureviews.with_productivity, path)
    featurestore.derive_if_absent(stats, lambda rows: featureviews.with_productivity(rows).limit(0), path)
    return present(spark.read.parquet(path))


def new_table(spark, sf_dir):
    """A table that must not be there yet."""
    path = scratch_path(spark, "new-table")
    sinks.write_new(cleaning.clean(adapters.transactions(spark, sf_dir)), path)
    return present(transactions.read_parquet(spark, path))


def tagged_text_profile(spark, sf_dir):
    """Numbers that arrive as text: the tag makes them numeric columns, unparsable text becomes null."""
    rows = adapters.read_table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 31 == 4, "n/a").otherwise(F.col("value").cast("string"))
    tagged = rows.select("event_id", text.alias("amount", metadata={"numeric": True}), F.col("event_type").alias("kind"))
    names = numeric_columns(tagged)
    parsed = as_numeric(tagged, names)
    long = profile.column_rows(parsed, [], names).groupBy("code").agg(
        F.count("value").alias("non_null"), F.sum("value").alias("total"), F.max("value").alias("max")
    )
    return present(long.select(F.array(*[F.lit(n) for n in names])[F.col("code")].alias("column"), "non_null", "total", "max"))


@pandas_udf(T.DoubleType())
def linear_combination(a: pd.Series, x: pd.Series, b: pd.Series, y: pd.Series) -> pd.Series:
    return a * x + b * y


def on_demand_function(spark, sf_dir):
    """An on-demand feature computed by a Python function over Arrow batches."""
    stats = materialize(adapters.driver_stats(spark, sf_dir), "stats")
    built = featureviews.driver_catalog(stats, featureviews.with_productivity(stats))
    quality = built.view("driver_quality_metrics")
    inputs = featureviews.RequestSource("linear_coefficients", {"conv_rate_coef": "double", "acc_rate_coef": "double"})
    view = featureviews.OnDemandView(
        "linear", (quality, inputs),
        {"linear_combination": lambda: linear_combination("conv_rate_coef", "conv_rate", "acc_rate_coef", "acc_rate")},
    )
    catalog = featureviews.FeatureCatalog([quality], [view])
    names = [f"{quality.name}:conv_rate", f"{quality.name}:acc_rate", "linear:linear_combination"]
    return present(catalog.historical(adapters.feature_requests(spark, sf_dir), names))


QUERIES = {
    f.__name__: f
    for f in [
        rows_by_file,
        dated_slices,
        corrupt_rows,
        profile_reports,
        correlation_reports,
        derived_source,
        new_table,
        tagged_text_profile,
        on_demand_function,
    ]
}

ORACLE = {
    "rows_by_file": f"""with {TX} select cast(cast(tx_datetime as date) as varchar) as date, count(*) as "rows", 0::bigint as unlisted
      from tx where transaction_id is not null group by cast(tx_datetime as date)""",
    "dated_slices": f"""with {TX} select transaction_id, strftime(tx_datetime, '%Y-%m-%d %H:%M:%S.%f') as tx_datetime, {r('tx_amount')} as tx_amount
      from tx where cast(tx_datetime as date) = date '2024-01-15'""",
    "corrupt_rows": f"""select case when event_id % 97 <> 5 then event_id end as transaction_id,
        case when event_id % 97 <> 5 then user_id end as customer_id, case when event_id % 97 <> 5 then {r('value')} end as tx_amount,
        case when event_id % 97 = 5 then 'x' || event_id || ';broken' end as broken from events""",
    "profile_reports": daily.ORACLE["profile_daily"],
    "correlation_reports": daily.ORACLE["correlation_long"],
    "derived_source": retrieval.ORACLE["productivity"],
    "new_table": daily.ORACLE["clean_transactions"],
    "tagged_text_profile": f"""select 'event_id' as "column", count(event_id) as non_null, {r('sum(event_id)')} as total, {r('max(event_id)')} as "max" from events
      union all select 'amount', count(*), {r('sum(value)')}, {r('max(value)')} from events where event_id % 31 <> 4 and value is not null""",
    "on_demand_function": retrieval.ORACLE["on_demand_linear"],
}
