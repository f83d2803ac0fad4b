"""Point-in-time joins: for each request row, the latest feature row that was known and not too old.

All sides are stacked and one running ``last`` fills the request rows, so the work is one shuffle
whatever the number of feature tables. Partitions are (key, time bucket), not key alone. A bucket is
as wide as the longest time-to-live: only the newest row of the bucket before can still be needed,
and that single row is carried forward. If the fullest (key, bucket) is over a bound, the buckets
are made narrower until it is not, and rows are carried over as many buckets as needed; a key that
holds most of the table is therefore cut into slices of bounded size.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.workspace import checked_broadcast, materialize

DEFAULT_BUCKET = dt.timedelta(days=30)
SLICE_ROWS = 10_000_000
SHORTEST_SLICE = 1_000_000  # microseconds
MICROSECOND = dt.timedelta(microseconds=1)


@dataclass(frozen=True)
class FeatureTable:
    """Feature rows with an event time and, optionally, a creation time that breaks ties."""

    frame: DataFrame
    columns: dict[str, tuple[str, dt.timedelta | None]]  # output name -> (column, time-to-live)
    timestamp: str = "event_timestamp"
    created: str | None = "created"

    def longest_ttl(self) -> dt.timedelta | None:
        lives = [ttl for _, ttl in self.columns.values()]
        return None if any(t is None for t in lives) else max(lives)


def micros(column: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970. Zone-less times are read off their calendar fields, in no time zone."""
    if not isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp"))
    minutes = F.unix_date(column.cast("date")).cast("bigint") * 1440 + F.hour(column) * 60 + F.minute(column)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")


def latest_per_key(
    df: DataFrame, keys: list[str], timestamp: str = "event_timestamp", created: str | None = "created"
) -> DataFrame:
    """Newest row per key; equal event times are settled by the newest creation time.

    ``max`` of a struct combines map-side, so a hot key sends one row per task. Columns outside the
    ordering take part in the comparison last, which makes the result independent of row order.
    """
    order = [timestamp, *([created] if created else [])]
    rest = [c for c in df.columns if c not in {*keys, *order}]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("r"))
    return newest.select(*keys, *[F.col(f"r.{c}").alias(c) for c in df.columns if c not in keys])


def deduplicate(df: DataFrame, keys: list[str], timestamp: str, created: str) -> DataFrame:
    """One row per key and event time: the newest created."""
    return latest_per_key(df, [*keys, timestamp], created, None).select(df.columns)


def asof_join(
    requests: DataFrame,
    tables: list[FeatureTable],
    keys: list[str],
    timestamp: str = "event_timestamp",
    bucket: dt.timedelta | None = None,
    slice_rows: int | None = SLICE_ROWS,
) -> DataFrame:
    """Left as-of join of ``requests`` with every table at once.

    A feature matches when ``feature time <= request time`` and the age is at most the column's
    time-to-live (both ends inclusive); the newest match wins. Request rows are all kept.
    ``bucket`` overrides the slice width; without a time-to-live the default is 30 days.
    ``slice_rows`` bounds the rows of one (key, bucket): a count over the two key columns checks it.
    None skips the check, for inputs known to be even.
    """
    kind = requests.schema[timestamp].dataType
    lives = [t.longest_ttl() for t in tables]
    bounded = all(life is not None for life in lives)
    size = (bucket or (max(lives) if bounded else DEFAULT_BUCKET)) // MICROSECOND
    reach = max(lives) // MICROSECOND if bounded else None
    features = [_feature_rows(table, keys, kind) for table in tables]
    asked = requests.select(
        *keys,
        F.col(timestamp).alias("_at"),
        micros(F.col(timestamp), kind).alias("_us"),
        F.struct(*requests.columns).alias("_row"),
    )
    if slice_rows:
        size = _narrowed(size, [*features, asked], keys, slice_rows)
    cut = F.floor(F.col("_us") / F.lit(size)).cast("bigint").alias("_bucket")
    asked = asked.select("*", cut).drop("_us")
    parts = [asked.withColumn("_side", F.lit(1))]
    for i, rows in enumerate(features):
        slot = rows.select(*keys, cut, "f")
        newest = slot.groupBy(*keys, "_bucket").agg(F.max("f").alias("f"))
        if reach is not None and reach <= size:
            carried = newest.withColumn("_bucket", F.col("_bucket") + 1)
        else:
            carried = _carry_any_distance(newest, asked, keys)
        for part in (slot, carried):
            columns = (*keys, "_bucket", F.col("f.at").alias("_at"), F.col("f").alias(f"_f{i}"), F.lit(0).alias("_side"))
            parts.append(part.select(*columns))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    window = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy("_at", "_side", *[f"_f{i}" for i in range(len(tables))])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = stacked.withColumns(
        {f"_f{i}": F.last(f"_f{i}", ignorenulls=True).over(window) for i in range(len(tables))}
    ).filter("_side = 1")
    out = [F.col(f"_row.{c}").alias(c) for c in requests.columns]
    for i, table in enumerate(tables):
        age = micros(F.col("_at"), kind) - micros(F.col(f"_f{i}.at"), kind)
        for name, (column, ttl) in table.columns.items():
            value = F.col(f"_f{i}.v_{column}")
            if ttl is not None:
                value = F.when(age <= F.lit(ttl // MICROSECOND), value)
            out.append(value.alias(name))
    return filled.select(*out)


def _feature_rows(table: FeatureTable, keys: list[str], kind: T.DataType) -> DataFrame:
    """(keys, _us, f): ``f`` orders by event time, then creation time, then values."""
    stamp = F.col(table.timestamp).cast(kind)
    created = F.lit(0)
    if table.created:
        made = table.frame.schema[table.created].dataType
        stamped = isinstance(made, (T.TimestampType, T.TimestampNTZType))
        created = micros(F.col(table.created), made) if stamped else F.col(table.created).cast("bigint")
    used = sorted({c for c, _ in table.columns.values()})
    row = F.struct(stamp.alias("at"), created.alias("made"), *[F.col(c).alias(f"v_{c}") for c in used])
    known = table.frame.filter(F.col(table.timestamp).isNotNull())
    return known.select(*keys, micros(stamp, kind).alias("_us"), row.alias("f"))


def _narrowed(size: int, sides: list[DataFrame], keys: list[str], slice_rows: int) -> int:
    """The bucket size, divided until the fullest (key, bucket) holds at most ``slice_rows`` (or a second)."""
    while True:
        cut = F.floor(F.col("_us") / F.lit(size)).alias("_bucket")
        both = reduce(lambda a, b: a.unionAll(b), [side.select(*keys, cut) for side in sides])
        counts = both.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("n"))
        fullest = counts.agg(F.max("n")).first()[0] or 0
        if fullest <= slice_rows or size <= SHORTEST_SLICE:
            return size
        size = max(SHORTEST_SLICE, size // math.ceil(fullest / slice_rows))


def _carry_any_distance(newest: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """For each bucket with requests, the newest feature row of any earlier bucket.

    The window runs over one row per key and bucket, not over data rows.
    """
    order = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    wanted = asked.groupBy(*keys, "_bucket").agg(F.lit(True).alias("wanted"))
    both = newest.join(wanted, [*keys, "_bucket"], "full_outer")
    carried = both.withColumn("f", F.last("f", ignorenulls=True).over(order))
    return carried.filter("wanted and f is not null").select(*keys, "_bucket", "f")


def validity_join(
    requests: DataFrame,
    features: DataFrame,
    keys: list[str],
    columns: list[str],
    ttl: dt.timedelta,
    timestamp: str = "event_timestamp",
    created: str | None = "created",
    slot: dt.timedelta | None = None,
    slice_rows: int | None = SLICE_ROWS,
) -> DataFrame:
    """The same result as a range join on disjoint validity intervals.

    Each feature row is valid from its event time until the next row of its key or until it is too
    old, whichever comes first, so a request meets at most one row. Both sides are cut into time
    slots and joined on (key, slot); choose ``slot`` near the feature cadence to keep the candidates
    of a slot few. A (key, slot) with more than ``slice_rows`` rows of both sides is cut into as many equal
    sub-slots as it needs, and only the intervals that reach over their edges are repeated; None skips the count.
    """
    kind = requests.schema[timestamp].dataType
    life = ttl // MICROSECOND
    size = (slot or ttl) // MICROSECOND
    feats = features.select(*keys, timestamp, *([created] if created else []), *columns)
    if created:
        feats = deduplicate(feats, keys, timestamp, created)
    else:
        feats = feats.dropDuplicates([*keys, timestamp])
    start = micros(F.col(timestamp), kind)
    feats = feats.select(*keys, start.alias("_from"), *columns).withColumn(
        "_bucket", F.floor(F.col("_from") / life)
    )
    # The first row of a bucket also ends the validity of the last row of the bucket before.
    stops = feats.groupBy(*keys, "_bucket").agg(F.min("_from").alias("_from"))
    stops = stops.withColumn("_bucket", F.col("_bucket") - 1).withColumn("_stop", F.lit(True))
    order = Window.partitionBy(*keys, "_bucket").orderBy("_from")
    valid = (
        feats.withColumn("_stop", F.lit(False))
        .unionByName(stops, allowMissingColumns=True)
        .withColumn("_next", F.lead("_from").over(order))
        .filter("not _stop")
        .withColumn("_to", F.least(F.col("_next") - 1, F.col("_from") + F.lit(life)))
        .withColumn("_slot", F.explode(F.sequence(F.floor(F.col("_from") / size), F.floor(F.col("_to") / size))))
        .select(*keys, "_slot", "_from", "_to", *columns)
    )
    at = micros(F.col(timestamp), kind)
    asked = requests.withColumns({"_at": at, "_slot": F.floor(at / size)})
    hot = _hot_slots(asked, valid, keys, slice_rows) if slice_rows else None
    asked, valid = _sub_slots(asked, valid, hot, keys, size)
    on = [asked[k] == valid[k] for k in keys] + [asked["_slot"] == valid["_slot"], asked["_sub"] == valid["_sub"]]
    on.append(asked["_at"].between(valid["_from"], valid["_to"]))
    joined = asked.join(valid, on, "left")
    return joined.select(*[asked[c] for c in requests.columns], *[valid[c] for c in columns])


def _hot_slots(asked: DataFrame, valid: DataFrame, keys: list[str], slice_rows: int) -> DataFrame | None:
    """(keys, _slot, _parts) of the slots with more than ``slice_rows`` rows; None if there are none."""
    both = asked.select(*keys, "_slot").unionAll(valid.select(*keys, "_slot"))
    counts = both.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_rows)
    parts = F.ceil(F.col("n") / F.lit(slice_rows)).cast("bigint").alias("_parts")
    hot = materialize(counts.select(*keys, "_slot", parts), "hot-slots")
    return None if hot.isEmpty() else hot


def _sub_slots(
    asked: DataFrame, valid: DataFrame, hot: DataFrame | None, keys: list[str], size: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_sub``: 0, or the part of its hot slot that a time lies in, or an interval reaches."""
    if hot is None:
        return asked.withColumn("_sub", F.lit(0).cast("bigint")), valid.withColumn("_sub", F.lit(0).cast("bigint"))
    known = checked_broadcast(hot, "hot-slots", stored=True)
    parts, start = F.coalesce("_parts", F.lit(1).cast("bigint")), F.col("_slot") * F.lit(size)

    def part_of(time: Column) -> Column:
        inside = F.least(F.greatest(time - start, F.lit(0).cast("bigint")), F.lit(size - 1).cast("bigint"))
        return F.floor(inside / (F.lit(float(size)) / parts)).cast("bigint")

    left = asked.join(known, [*keys, "_slot"], "left").select(*asked.columns, part_of(F.col("_at")).alias("_sub"))
    reach = F.sequence(part_of(F.col("_from")), part_of(F.col("_to")))
    right = valid.join(known, [*keys, "_slot"], "left").select(*valid.columns, F.explode(reach).alias("_sub"))
    return left, right
