import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyglass.operators import ranks


def _cells(spark, groups):
    rows = [(g, float(v), int(n)) for g, values in groups.items() for v, n in values]
    return spark.createDataFrame(rows, "g string, v double, n bigint").repartition(3)


def _expected(groups):
    out = {}
    for g, values in groups.items():
        total = 0
        for v, n in sorted(values):
            out[(g, float(v))] = total
            total += n
    return out


@pytest.mark.parametrize("split_above", [5, 10**6])
def test_running_sums_with_and_without_splits(spark, split_above):
    rng = np.random.default_rng(1)
    hot = [(v, rng.integers(1, 9)) for v in rng.permutation(400) / 7.0]
    groups = {"hot": hot, "small": [(3.0, 2), (1.0, 5)], "one": [(0.0, 1)]}
    out = ranks.running_sums(_cells(spark, groups), ["g"], "v", {"before": "n"}, split_above=split_above)
    assert {(r.g, r.v): r.before for r in out.collect()} == _expected(groups)


def test_a_hot_group_is_spread_over_buckets(spark):
    groups = {"hot": [(v, 1) for v in range(400)], "small": [(1.0, 1)]}
    cells = _cells(spark, groups)
    edges, stride = ranks.split_points(cells, ["g"], "v", 50)
    assert [r.g for r in edges.collect()] == ["hot"] and len(edges.first().edges) == 7 and stride == 2
    assert ranks.split_points(cells, ["g"], "v", 500) is None
    plan = ranks.running_sums(cells, ["g"], "v", {"b": "n"}, 50)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" in plan and "_bucket" in plan and "SinglePartition" not in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=40))
def test_average_ranks_match_pandas(spark, values):
    frame = spark.createDataFrame([(1, float(v)) for v in values], "g int, v double")
    got = {r.v: (r.n, r.avg_rank, r.ecdf) for r in ranks.average_ranks(frame, ["g"], "v", 3).collect()}
    series = pd.Series(values, dtype=float)
    expected = series.rank(method="average")
    for v, rank in zip(series, expected):
        assert got[v][0] == (series == v).sum()
        assert got[v][1] == rank
        assert got[v][2] == pytest.approx((series <= v).mean())


def test_nulls_are_not_ranked(spark):
    frame = spark.createDataFrame([(1, None), (1, 2.0)], "g int, v double")
    assert ranks.average_ranks(frame, ["g"], "v").agg(F.sum("n")).first()[0] == 1


@pytest.mark.parametrize("split_above", [3, 10**6])
def test_quantiles_are_exact(spark, split_above):
    rng = np.random.default_rng(5)
    values = rng.integers(0, 60, 301)
    frame = spark.createDataFrame([(1, int(v), float(v) / 3) for v in values], "g int, a int, b double")
    got = {r.column: r.q for r in ranks.quantiles(frame, ["g"], ["a", "b"], [0.25, 0.5, 0.75, 1.0], split_above).collect()}
    ordered = np.sort(values)
    want = [float(ordered[int(np.ceil(p * 301)) - 1]) for p in (0.25, 0.5, 0.75, 1.0)]
    assert got["a"] == want and got["b"] == [v / 3 for v in want]


@pytest.mark.parametrize("stride, edges", [(1, 1), (2, 7), (3, 10), (8, 63)])
def test_bucket_lookup(spark, stride, edges):
    frame = spark.range(-1, edges + 2).select(F.lit("g").alias("g"), (F.col("id") + 0.5).alias("v"))
    frame = frame.union(spark.createDataFrame([("other", 3.5)], "g string, v double"))
    table = spark.createDataFrame([("g", [float(i) for i in range(edges)])], "g string, edges array<double>")
    rows = ranks.with_bucket(frame, ["g"], "v", table, stride).collect()
    assert len(rows) == edges + 4
    for r in rows:
        assert r._bucket == (0 if r.g == "other" else sum(e < r.v for e in range(edges)))
