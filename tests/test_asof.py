import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyglass.operators import featureviews
from tallyglass.operators.asof import FeatureTable, asof_join, latest_per_key, validity_join

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2024, 1, 10)
FEATURES = "k int, event_timestamp timestamp_ntz, created timestamp_ntz, v double"
REQUESTS = "id int, k int, event_timestamp timestamp_ntz"


def _expected(requests, features, ttl):
    out = {}
    for i, k, at in requests:
        known = [(t, c, v) for fk, t, c, v in features if fk == k and t <= at and (ttl is None or at - t <= ttl)]
        out[i] = max(known)[2] if known else None
    return out


def _random_case(seed, n=300):
    rng = random.Random(seed)
    stamp = lambda: T0 + dt.timedelta(seconds=rng.randrange(0, 10 * 86400, 1800))
    key = lambda: 1 if rng.random() < 0.4 else rng.randrange(2, 9)  # noqa: E731 - one hot key
    features = {}
    for i in range(n):
        row = (key(), stamp(), T0 + dt.timedelta(seconds=i), float(i))
        features[row[:3]] = row
    return [(i, key(), stamp()) for i in range(n)], list(features.values())


@pytest.mark.parametrize("ttl", [dt.timedelta(hours=6), 2 * DAY, None])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, ttl, seed):
    requests, features = _random_case(seed)
    left, right = spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(features, FEATURES)
    joined = asof_join(left, [FeatureTable(right, {"v": ("v", ttl)})], ["k"], bucket=dt.timedelta(hours=13))
    assert {r.id: r.v for r in joined.collect()} == _expected(requests, features, ttl)
    sliced = asof_join(left, [FeatureTable(right, {"v": ("v", ttl)})], ["k"], slice_rows=7)
    assert {r.id: r.v for r in sliced.collect()} == _expected(requests, features, ttl)
    if ttl:
        for slot in (ttl, ttl / 3):
            ranged = validity_join(left, right, ["k"], ["v"], ttl, slot=slot)
            assert {r.id: r.v for r in ranged.collect()} == _expected(requests, features, ttl)


def test_edges_ties_and_missing_keys(spark):
    at = dt.datetime(2024, 1, 10, 12)
    features = [
        (1, at, at, 1.0),
        (1, at, at + dt.timedelta(hours=1), 2.0),  # same event time, created later: wins
        (2, at - DAY, at, 3.0),  # exactly as old as allowed: counts
        (3, at - DAY - dt.timedelta(microseconds=1), at, 4.0),  # a microsecond too old
        (4, at + dt.timedelta(microseconds=1), at, 5.0),  # from the future
    ]
    requests = spark.createDataFrame([(k, k, at) for k in (1, 2, 3, 4, 9)], REQUESTS)
    table = FeatureTable(spark.createDataFrame(features, FEATURES), {"v": ("v", DAY)})
    got = {r.id: r.v for r in asof_join(requests, [table], ["k"]).collect()}
    assert got == {1: 2.0, 2: 3.0, 3: None, 4: None, 9: None}


def test_repeated_requests_are_kept(spark):
    at = dt.datetime(2024, 1, 10, 12)
    requests = spark.createDataFrame([(1, 1, at)] * 3, REQUESTS)
    table = FeatureTable(spark.createDataFrame([(1, at, at, 7.0)], FEATURES), {"v": ("v", DAY)})
    assert [r.v for r in asof_join(requests, [table], ["k"]).collect()] == [7.0] * 3


def test_one_shuffle_of_rows_and_no_join(spark):
    requests, features = _random_case(3, 50)
    left, right = spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(features, FEATURES)
    tables = [FeatureTable(right, {"v": ("v", DAY), "w": ("v", 2 * DAY)}), FeatureTable(right, {"x": ("v", 3 * DAY)})]
    plan = asof_join(left, tables, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Window [") == 1 and "hashpartitioning(k" in plan and "_bucket" in plan


def test_latest_per_key(spark):
    _, features = _random_case(4)
    frame = spark.createDataFrame(features, FEATURES)
    want = {}
    for k, t, c, v in features:
        want[k] = max(want.get(k, (dt.datetime.min,) * 2 + (0.0,)), (t, c, v))
    assert {r.k: r.v for r in latest_per_key(frame, ["k"]).collect()} == {k: w[2] for k, w in want.items()}


# Published sample: (driver, request time, coefficients, rates, trips, product, combination).
SAMPLE = [
    (1001, dt.datetime(2021, 4, 12, 10, 59, 42), 2.5, 1.2, 0.731652, 0.865659, 193, 122.238681, 2.867921),
    (1002, dt.datetime(2021, 4, 12, 8, 12, 10), 0.3, 0.7, 0.841482, 0.702492, 19, 11.231548, 0.744189),
    (1003, dt.datetime(2021, 4, 12, 16, 40, 26), 2.0, 15.0, 0.898103, 0.751486, 358, 241.618530, 13.068497),
]
STATS = "driver_id int, event_timestamp timestamp_ntz, created timestamp_ntz, conv_rate double, acc_rate double, avg_daily_trips bigint"
NAMES = [
    "driver_quality_metrics:conv_rate",
    "driver_quality_metrics:acc_rate",
    "driver_activity_rates_linear_combination_fv:linear_combination",
    "driver_productivity_metrics:productivity",
]


@pytest.fixture(scope="module")
def catalog(spark):
    rows = []
    for driver, at, _, _, conv, acc, trips, _, _ in SAMPLE:
        seen = at - dt.timedelta(minutes=30)
        rows.append((driver, seen, seen + dt.timedelta(minutes=5), conv, acc, trips))
        rows.append((driver, seen, seen, 0.1, 0.1, 1))  # older version of the same row
        rows.append((driver, at + dt.timedelta(seconds=1), at, 0.2, 0.2, 2))  # later than the request
        rows.append((driver, at - 9 * DAY, at, 0.3, 0.3, 3))  # too old
    stats = spark.createDataFrame(rows, STATS)
    return featureviews.driver_catalog(stats, featureviews.with_productivity(stats))


def _requests(spark):
    return spark.createDataFrame(
        [s[:4] for s in SAMPLE], "driver_id int, event_timestamp timestamp_ntz, conv_rate_coef double, acc_rate_coef double"
    )


def test_published_sample(spark, catalog):
    got = {r.driver_id: r for r in catalog.historical(_requests(spark), NAMES).collect()}
    for driver, _, _, _, conv, acc, _, product, linear in SAMPLE:
        assert got[driver].conv_rate == pytest.approx(conv, abs=1e-5)
        assert got[driver].acc_rate == pytest.approx(acc, abs=1e-5)
        assert got[driver].productivity == pytest.approx(product, abs=1e-3)
        assert got[driver].linear_combination == pytest.approx(linear, abs=1e-5)


def test_online_columns_and_time_to_live(spark, catalog):
    asked = spark.createDataFrame(
        [(1001, 10.1, 1.01), (1002, 12.05, 0.76), (7, 1.0, 1.0)], "driver_id int, conv_rate_coef double, acc_rate_coef double"
    )
    fresh = catalog.online(asked, NAMES, dt.datetime(2021, 4, 13)).orderBy("driver_id")
    answer = catalog.to_columns(fresh)
    assert answer["driver_id"] == [7, 1001, 1002] and answer["conv_rate"] == [None, 0.2, 0.2]
    assert answer["linear_combination"][1] == pytest.approx(10.1 * 0.2 + 1.01 * 0.2)
    later = catalog.to_columns(catalog.online(asked, NAMES, dt.datetime(2021, 4, 16)).orderBy("driver_id"))
    assert later["conv_rate"] == [None] * 3 and later["productivity"][1] is not None  # 2 days against 7


def test_names_services_and_errors(spark, catalog):
    service = featureviews.driver_service(catalog)
    assert service.references()[-1] == NAMES[2]
    assert set(catalog.historical(_requests(spark), service).columns) >= {"conv_rate", "acc_rate", "linear_combination"}
    both = ["driver_hourly_stats:conv_rate", "driver_quality_metrics:conv_rate"]
    with pytest.raises(ValueError):
        catalog.historical(_requests(spark), both)
    named = catalog.historical(_requests(spark), both, full_names=True)
    assert named.columns[-2:] == ["driver_hourly_stats__conv_rate", "driver_quality_metrics__conv_rate"]
    with pytest.raises(KeyError):
        catalog.historical(_requests(spark), ["driver_quality_metrics:absent"])
    with pytest.raises(KeyError):
        catalog.historical(_requests(spark).drop("acc_rate_coef"), NAMES)
    meta = {(r.view, r.ttl_seconds) for r in catalog.describe(spark).collect()}
    assert meta == {("driver_hourly_stats", 86400), ("driver_quality_metrics", 172800), ("driver_productivity_metrics", 604800)}


def test_zone_less_times_ignore_the_session_zone(spark):
    requests, features = _random_case(5, 80)
    left, right = spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(features, FEATURES)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        joined = asof_join(left, [FeatureTable(right, {"v": ("v", DAY)})], ["k"])
        assert {r.id: r.v for r in joined.collect()} == _expected(requests, features, DAY)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_on_demand_may_use_a_pandas_function(spark, catalog):
    import pandas as pd
    from pyspark.sql.functions import pandas_udf
    from pyspark.sql.types import DoubleType

    @pandas_udf(DoubleType())
    def doubled(x: pd.Series) -> pd.Series:
        return x * 2

    quality = catalog.view("driver_quality_metrics")
    view = featureviews.OnDemandView("twice", (quality,), {"conv_twice": lambda: doubled(F.col("conv_rate"))})
    own = featureviews.FeatureCatalog([quality], [view])
    got = own.historical(_requests(spark), ["twice:conv_twice"]).orderBy("driver_id").first()
    assert got.conv_twice == pytest.approx(2 * 0.731652)


def test_materialised_sources_serve_the_same_values(spark, catalog, tmp_path):
    asked = spark.createDataFrame([(1001, 1.0, 1.0), (1002, 1.0, 1.0)], "driver_id int, conv_rate_coef double, acc_rate_coef double")
    cut = dt.datetime(2021, 4, 12, 10)
    catalog.materialize(spark, str(tmp_path), 1, start=cut)
    tables = catalog.materialize(spark, str(tmp_path), 2, end=cut)
    assert set(tables) == {"driver_hourly_stats_source", "driver_hourly_stats_source_with_productivity"}
    now = dt.datetime(2021, 4, 13)
    direct = catalog.online(asked, NAMES, now).orderBy("driver_id").collect()
    assert catalog.online(asked, NAMES, now, tables).orderBy("driver_id").collect() == direct


def test_offline_views_are_not_served(spark, catalog):
    import dataclasses

    hidden = dataclasses.replace(catalog.view("driver_quality_metrics"), online=False)
    asked = spark.createDataFrame([(1001,)], "driver_id int")
    with pytest.raises(ValueError):
        featureviews.FeatureCatalog([hidden]).online(asked, ["driver_quality_metrics:conv_rate"], T0)


def test_hot_slots_are_cut_and_the_result_stays(spark):
    """One key holds most rows, many of them in one slot; sub-slots give the rows of the plain join."""
    import random

    from tallyglass.operators import asof

    rng = random.Random(6)
    t0 = dt.datetime(2024, 1, 1)
    facts = [(1 if rng.random() < 0.7 else rng.randrange(2, 5), t0 + dt.timedelta(seconds=rng.randrange(90_000)), t0, rng.random()) for _ in range(400)]
    asked = [(i, 1 if rng.random() < 0.7 else rng.randrange(2, 6), t0 + dt.timedelta(seconds=rng.randrange(100_000))) for i in range(500)]
    asked += [(900 + i, 1, t0 + dt.timedelta(hours=5)) for i in range(60)] + [(990, None, t0)]
    f = spark.createDataFrame(facts, "k int, event_timestamp timestamp_ntz, created timestamp_ntz, v double")
    q = spark.createDataFrame(asked, "id int, k int, event_timestamp timestamp_ntz")
    life, slot = dt.timedelta(hours=2), dt.timedelta(hours=12)
    plain = asof.validity_join(q, f, ["k"], ["v"], life, slot=slot, slice_rows=None)
    cut = asof.validity_join(q, f, ["k"], ["v"], life, slot=slot, slice_rows=25)
    assert sorted(map(repr, map(tuple, cut.collect()))) == sorted(map(repr, map(tuple, plain.collect())))
    joined = asof.asof_join(q, [asof.FeatureTable(f, {"v": ("v", life)})], ["k"])
    assert sorted(map(repr, map(tuple, cut.collect()))) == sorted(map(repr, map(tuple, joined.collect())))
