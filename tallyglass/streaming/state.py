"""Keyed state in streams: the newest row per key, and point-in-time features of arriving requests."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyglass.streaming.jobs import wall_clock

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "newest"
EPOCH = dt.datetime(1970, 1, 1)
MILLISECOND = dt.timedelta(milliseconds=1)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB: typed state needs it, and it is not held on the heap."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _order(value) -> tuple:
    """Spark's order of one field: null first, NaN last."""
    if value is None:
        return (0, 0)
    return (2, 0) if isinstance(value, float) and math.isnan(value) else (1, value)


class NewestRow(StatefulProcessor):
    """One value state per key: the newest row, by event time, then creation time, then the other columns.

    With ``ttl`` and event time a timer of the key fires when the watermark has passed the newest row's time by
    ``ttl``; the key leaves the state and a row marked ``expired`` is sent. In processing time the state store drops
    the row itself, ``ttl`` after it was last written.
    """

    def __init__(self, row: T.StructType, order: list[str], ttl: dt.timedelta | None, event_time: bool):
        self.row, self.order, self.timestamp, self.event_time = row, order, order[0], event_time
        self.ttl = None if ttl is None else int(ttl / MILLISECOND)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        lifetime = self.ttl if self.ttl is not None and not self.event_time else None
        self.newest = handle.getValueState(STATE, self.row, lifetime)

    def _place(self, row: Row) -> tuple:
        return tuple(_order(row[c]) for c in self.order)

    def _expiry(self, row: Row) -> int:
        at = row[self.timestamp]
        if at.tzinfo is not None:
            at = at.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return int((at - EPOCH) / MILLISECOND) + self.ttl

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = Row(*self.row.names)(*self.newest.get()) if self.newest.exists() else None
        best = known
        for row in rows:
            if row[self.timestamp] is not None and (best is None or self._place(row) > self._place(best)):
                best = row
        if best is None or best is known:
            return
        if self.ttl is not None and self.event_time:
            if known is not None:
                self.handle.deleteTimer(self._expiry(known))
            self.handle.registerTimer(self._expiry(best))
        values = tuple(best[c] for c in self.row.names)
        self.newest.update(values)
        yield Row(*self.row.names, "expired")(*values, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.newest.exists():
            values = tuple(self.newest.get())
            self.newest.clear()
            yield Row(*self.row.names, "expired")(*values, True)

    def close(self) -> None:
        pass


def newest_changes(
    rows: DataFrame,
    keys: list[str],
    timestamp: str = "event_timestamp",
    created: str | None = "created",
    ttl: dt.timedelta | None = None,
    delay: str = "1 day",
    event_time: bool = True,
) -> DataFrame:
    """Stream of the rows that became their key's newest, and of the keys that expired (``expired`` is true).

    Rows without a time are ignored. In event time, rows later than ``delay`` behind the newest of all are dropped.
    In processing time a running query keeps making batches to look for expired rows, so it is never drained: start
    it with the default trigger, or let it run.
    """
    layout = T.StructType(rows.schema.fields)
    rest = [c for c in rows.columns if c not in {*keys, timestamp, created}]
    order = [timestamp, *([created] if created else []), *rest]
    mode, timed = "ProcessingTime", rows
    if event_time:
        mode, timed = "EventTime", rows.withColumn("_at", wall_clock(timestamp)).withWatermark("_at", delay)
    return timed.groupBy(*keys).transformWithState(
        statefulProcessor=NewestRow(layout, order, ttl, event_time),
        outputStructType=T.StructType(layout.fields + [T.StructField("expired", T.BooleanType())]),
        outputMode="Update",
        timeMode=mode,
    )


def start_changes(changes: DataFrame, checkpoint: str, write, **trigger) -> StreamingQuery:
    """Start a change stream into ``write(batch, number)``; drains what is there unless a trigger is given."""
    with rocksdb_state(changes.sparkSession):
        writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update")
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_newest(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The newest rows as the last finished micro-batch left them in the state."""
    with rocksdb_state(spark):
        state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    with_lifetime = "ttlExpirationMs" in state.schema["value"].dataType.names  # a lifetime wraps the value
    return state.select("value.value.*" if with_lifetime else "value.*")


def asof_stream(
    requests: DataFrame,
    features: DataFrame,
    keys: list[str],
    request_id: list[str],
    columns: list[str],
    ttl: dt.timedelta,
    timestamp: str = "event_timestamp",
    created: str | None = "created",
    delay: str = "1 day",
) -> DataFrame:
    """Point-in-time features of a stream of requests, from a stream of feature rows.

    An interval join under two watermarks meets a request with the feature rows of its key that are not newer than it
    and at most ``ttl`` older; an aggregate behind it holds only the newest. A request leaves once both streams'
    watermarks have passed its time, with nulls if nothing matched, and its state goes with it. Feature rows stay
    in the state for ``ttl`` and the delay. Rows later than ``delay`` are dropped. ``request_id`` tells requests
    apart; rows that repeat it, with all their columns, are one request.
    """
    order = [timestamp, *([created] if created else [])]
    asked = requests.withColumn("_at", wall_clock(timestamp)).withWatermark("_at", delay)
    row = F.struct(*order, *[F.col(c).alias(f"v_{c}") for c in columns])
    known = features.filter(F.col(timestamp).isNotNull()).select(
        *[F.col(k).alias(f"_{k}") for k in keys], wall_clock(timestamp).alias("_known"), row.alias("_f")
    ).withWatermark("_known", delay)
    life = F.expr(f"interval {int(ttl.total_seconds())} seconds")
    on = (F.col("_known") <= F.col("_at")) & (F.col("_known") >= F.col("_at") - life)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    joined = asked.join(known, on, "leftOuter").select(*requests.columns, "_at", "_f")
    rest = [c for c in requests.columns if c not in request_id]
    newest = joined.groupBy(*request_id, *rest, "_at").agg(F.max("_f").alias("_f"))
    return newest.select(*requests.columns, *[F.col(f"_f.v_{c}").alias(c) for c in columns])
