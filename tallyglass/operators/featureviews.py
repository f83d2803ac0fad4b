"""Feature views over DataFrames: definitions, historical and latest-value retrieval, metadata."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.operators.asof import FeatureTable, asof_join, latest_per_key, micros
from tallyglass.sources.featurestore import materialize_latest
from tallyglass.workspace import checked_broadcast


@dataclass(frozen=True)
class Entity:
    """The thing features describe, and the columns that identify it."""

    name: str
    join_keys: tuple[str, ...]


@dataclass(frozen=True)
class FeatureSource:
    """A table of feature rows: its DataFrame (or Parquet path), event-time and creation-time columns."""

    name: str
    table: DataFrame | str
    timestamp: str = "event_timestamp"
    created: str | None = "created"

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.table) if isinstance(self.table, str) else self.table


@dataclass(frozen=True)
class PushSource:
    """Rows that arrive by push; the batch source backs historical reads."""

    name: str
    batch_source: FeatureSource


@dataclass(frozen=True)
class RequestSource:
    """Values the caller supplies with each request: column name -> type."""

    name: str
    fields: dict[str, str]


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity: Entity
    source: FeatureSource
    features: tuple[str, ...]
    ttl: dt.timedelta | None = None
    online: bool = True
    tags: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class OnDemandView:
    """Features computed from stored features and request values: name -> Column over their names.

    A value may also be a pandas UDF call; a built-in expression keeps the work inside the JVM.
    """

    name: str
    inputs: tuple[FeatureView | RequestSource, ...]
    outputs: dict[str, Callable[[], Column]]


@dataclass(frozen=True)
class FeatureService:
    """A named bundle of views."""

    name: str
    views: tuple[FeatureView | OnDemandView, ...]

    def references(self) -> list[str]:
        names = []
        for view in self.views:
            columns = view.features if isinstance(view, FeatureView) else tuple(view.outputs)
            names += [f"{view.name}:{c}" for c in columns]
        return names


class FeatureCatalog:
    """Resolves ``view:feature`` names and runs one plan per request frame."""

    def __init__(self, views: list[FeatureView], on_demand: list[OnDemandView] | None = None):
        self._views = {v.name: v for v in views}
        self._on_demand = {v.name: v for v in on_demand or []}

    def view(self, name: str) -> FeatureView | OnDemandView:
        return self._views.get(name) or self._on_demand[name]

    def _resolve(self, features: list[str] | FeatureService) -> tuple[list, dict, list]:
        """Wanted (view, column) pairs, the stored ones they need, and the on-demand views in use."""
        references = features.references() if isinstance(features, FeatureService) else features
        wanted, stored, computed = [], {}, []
        for reference in references:
            name, _, column = reference.partition(":")
            wanted.append((name, column))
            if name in self._on_demand and column in self._on_demand[name].outputs:
                if self._on_demand[name] not in computed:
                    computed.append(self._on_demand[name])
                for view in self._on_demand[name].inputs:
                    if isinstance(view, FeatureView):
                        stored.update({(view.name, c): view for c in view.features})
            elif name in self._views and column in self._views[name].features:
                stored[(name, column)] = self._views[name]
            else:
                raise KeyError(reference)
        return wanted, stored, computed

    @staticmethod
    def _check_request(requests: DataFrame, computed: list[OnDemandView]) -> None:
        for source in (s for view in computed for s in view.inputs if isinstance(s, RequestSource)):
            missing = set(source.fields) - set(requests.columns)
            if missing:
                raise KeyError(f"request values missing for {source.name}: {sorted(missing)}")

    @staticmethod
    def _finish(joined: DataFrame, requests: DataFrame, wanted: list, computed: list, full_names: bool) -> DataFrame:
        """Evaluate the on-demand columns and settle the output names."""
        for view in computed:
            plain = {c: F.col(f"{v.name}__{c}") for v in view.inputs if isinstance(v, FeatureView) for c in v.features}
            shadow = {c: F.col(c) for c in requests.columns}
            frame = joined.withColumns({c: value for c, value in plain.items() if c not in shadow})
            frame = frame.withColumns({f"{view.name}__{c}": build() for c, build in view.outputs.items()})
            joined = frame.drop(*[c for c in plain if c not in shadow])
        names = [f"{v}__{c}" if full_names else c for v, c in wanted]
        if len(set(names)) < len(names):
            raise ValueError("two views serve the same feature name; ask with full_names=True")
        out = [F.col(f"{v}__{c}").alias(name) for (v, c), name in zip(wanted, names)]
        return joined.select(*requests.columns, *out)

    @staticmethod
    def _by_source(stored: dict) -> dict[str, list[tuple[str, FeatureView]]]:
        grouped: dict[str, list[tuple[str, FeatureView]]] = {}
        for (_, column), view in stored.items():
            grouped.setdefault(view.source.name, []).append((column, view))
        return grouped

    def historical(
        self,
        requests: DataFrame,
        features: list[str] | FeatureService,
        timestamp: str = "event_timestamp",
        full_names: bool = False,
    ) -> DataFrame:
        """Point-in-time values of every feature for every request row, in one pass.

        Views of one source share its rows; different sources are stacked in the same shuffle.
        """
        wanted, stored, computed = self._resolve(features)
        self._check_request(requests, computed)
        tables = []
        for members in self._by_source(stored).values():
            source = members[0][1].source
            columns = {f"{view.name}__{column}": (column, view.ttl) for column, view in members}
            tables.append(FeatureTable(source.frame(requests.sparkSession), columns, source.timestamp, source.created))
        joined = asof_join(requests, tables, self._keys(stored), timestamp)
        return self._finish(joined, requests, wanted, computed, full_names)

    def online(
        self,
        entity_rows: DataFrame,
        features: list[str] | FeatureService,
        as_of: dt.datetime,
        latest: dict[str, DataFrame] | None = None,
        full_names: bool = False,
    ) -> DataFrame:
        """Latest value per key for the asked entities; values older than the time-to-live are null.

        ``latest`` maps source names to materialised latest-row tables; without it the newest rows are
        derived from the sources, after a semi-join to the asked keys.
        """
        wanted, stored, computed = self._resolve(features)
        self._check_request(entity_rows, computed)
        offline = sorted({view.name for view in stored.values() if not view.online})
        if offline:
            raise ValueError(f"views without online serving: {offline}")
        keys = self._keys(stored)
        asked = checked_broadcast(entity_rows.select(*keys).distinct(), "asked-keys")
        out = entity_rows
        for name, members in self._by_source(stored).items():
            source = members[0][1].source
            rows = (latest or {}).get(name)
            if rows is None:
                rows = source.frame(entity_rows.sparkSession)
            kind = rows.schema[source.timestamp].dataType
            now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)
            columns = sorted({c for c, _ in members})
            order = [source.timestamp, *([source.created] if source.created else [])]
            known = rows.filter(F.col(source.timestamp) <= now).select(*keys, *order, *columns)
            newest = latest_per_key(known.join(asked, keys, "left_semi"), keys, source.timestamp, source.created)
            age = micros(now, kind) - micros(F.col(source.timestamp), kind)
            fresh = [
                (F.col(c) if v.ttl is None else F.when(age <= v.ttl // dt.timedelta(microseconds=1), F.col(c))).alias(
                    f"{v.name}__{c}"
                )
                for c, v in members
            ]
            out = out.join(newest.select(*keys, *fresh), keys, "left")
        return self._finish(out, entity_rows, wanted, computed, full_names)

    def materialize(
        self,
        spark: SparkSession,
        root: str,
        batch: int,
        start: dt.datetime | None = None,
        end: dt.datetime | None = None,
    ) -> dict[str, DataFrame]:
        """Load the newest rows of every online source whose event time is in [start, end).

        Each source has a latest-row table under ``root``; a batch may be repeated. The result is the
        ``latest`` argument of ``online``.
        """
        tables = {}
        for view in self._views.values():
            source = view.source
            if not view.online or source.name in tables:
                continue
            rows, kind = source.frame(spark), source.frame(spark).schema[source.timestamp].dataType
            for bound, inside in ((start, F.col(source.timestamp).__ge__), (end, F.col(source.timestamp).__lt__)):
                if bound is not None:
                    rows = rows.filter(inside(F.lit(bound.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)))
            keys = list(view.entity.join_keys)
            path = f"{root}/{source.name}"
            tables[source.name] = materialize_latest(spark, rows, path, batch, keys, source.timestamp, source.created)
        return tables

    @staticmethod
    def to_columns(rows: DataFrame, limit: int = 10_000) -> dict[str, list]:
        """Column dictionary of a bounded online answer."""
        table = rows.limit(limit + 1).toArrow()
        if table.num_rows > limit:
            raise ValueError(f"more than {limit} rows; keep the answer as a DataFrame")
        return table.to_pydict()

    @staticmethod
    def _keys(stored: dict[str, FeatureView]) -> list[str]:
        keys = {v.entity.join_keys for v in stored.values()}
        if len(keys) != 1:
            raise ValueError(f"features of one request must share their entity, got {sorted(keys)}")
        return list(keys.pop())

    def describe(self, spark: SparkSession) -> DataFrame:
        """One row per view and feature: entity, keys, time-to-live in seconds, online flag, tags."""
        rows = [
            (v.name, v.entity.name, ",".join(v.entity.join_keys), v.source.name, int(v.ttl.total_seconds()) if v.ttl else None, v.online, f, v.tags)
            for v in self._views.values()
            for f in v.features
        ]
        schema = "view string, entity string, join_keys string, source string, ttl_seconds bigint, online boolean, feature string, tags map<string,string>"
        return spark.createDataFrame(rows, schema)


def with_productivity(stats: DataFrame) -> DataFrame:
    """The product feature of the second source."""
    return stats.withColumn("productivity", F.col("conv_rate") * F.col("acc_rate") * F.col("avg_daily_trips"))


def driver_catalog(stats: DataFrame | str, productivity: DataFrame | str) -> FeatureCatalog:
    """The driver feature set: three stored views and one on-demand view."""
    # Names, times-to-live and tags of the driver views.
    driver = Entity("driver", ("driver_id",))
    hourly = FeatureSource("driver_hourly_stats_source", stats)
    product = FeatureSource("driver_hourly_stats_source_with_productivity", productivity)
    stats_view = FeatureView(
        "driver_hourly_stats",
        driver,
        hourly,
        ("conv_rate", "acc_rate", "avg_daily_trips"),
        dt.timedelta(days=1),
        tags={"team": "driver_performance"},
    )
    quality = FeatureView(
        "driver_quality_metrics",
        driver,
        hourly,
        ("conv_rate", "acc_rate"),
        dt.timedelta(days=2),
        tags={"team": "driver_analytics", "category": "quality"},
    )
    productive = FeatureView(
        "driver_productivity_metrics",
        driver,
        product,
        ("productivity",),
        dt.timedelta(days=7),
        tags={"team": "driver_analytics", "category": "productivity"},
    )
    coefficients = RequestSource("linear_coefficients", {"conv_rate_coef": "double", "acc_rate_coef": "double"})
    linear = OnDemandView(
        "driver_activity_rates_linear_combination_fv",
        (quality, coefficients),
        {
            "linear_combination": lambda: F.col("conv_rate_coef") * F.col("conv_rate")
            + F.col("acc_rate_coef") * F.col("acc_rate")
        },
    )
    return FeatureCatalog([stats_view, quality, productive], [linear])


def driver_service(catalog: FeatureCatalog) -> FeatureService:
    """Fixed value: the service name and its members."""
    return FeatureService(
        "driver_activity_rates_linear_combination",
        (catalog.view("driver_quality_metrics"), catalog.view("driver_activity_rates_linear_combination_fv")),
    )
