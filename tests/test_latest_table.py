import datetime as dt

import pytest

from tallyglass.operators.asof import latest_per_key
from tallyglass.sources.latesttable import LatestTable

SCHEMA = "k int, event_timestamp timestamp_ntz, created timestamp_ntz, v double"
T0 = dt.datetime(2024, 1, 1)


def rows_of(spark, load, keys):
    return spark.createDataFrame([(k, T0 + dt.timedelta(hours=((k or 0) * 7 + load * 5) % 11), T0, float(load)) for k in keys], SCHEMA)


def test_lookup_opens_only_files_that_may_hold_the_keys(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), ("k",))
    loads = [rows_of(spark, 0, [*range(400), None]), rows_of(spark, 1, range(300, 700)), rows_of(spark, 2, range(0, 700, 3))]
    numbers = [table.load(rows, f"load{i}", rows_per_file=25) for i, rows in enumerate(loads)]
    assert numbers == [1, 2, 3] and table.load(loads[0], "load0", rows_per_file=25) is None
    everything = loads[0].unionByName(loads[1]).unionByName(loads[2])
    for keys in ([5], [1, 350, 699], list(range(0, 700, 50)), [10_000]):
        asked = spark.createDataFrame([(k,) for k in keys], "k int")
        want = latest_per_key(everything.filter(everything.k.isin(keys)), ["k"])
        assert sorted(map(tuple, table.lookup(asked).collect())) == sorted(map(tuple, want.collect()))
    one = table.candidates(spark.createDataFrame([(5,)], "k int"))
    assert len(one) == 1  # one of 17 + 16 + 10 files
    lost = table.candidates(spark.createDataFrame([(k,) for k in range(10_000, 10_040)], "k int"))
    assert len(lost) <= 4  # unknown keys: what the filters let through
    assert len(table.candidates(everything.select("k"))) > 30


def test_empty_loads_and_tables(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), ("k",))
    asked = spark.createDataFrame([(1,)], "k int")
    assert table.candidates(asked) == []
    with pytest.raises(ValueError):
        table.lookup(asked)
    table.load(rows_of(spark, 0, []).limit(0))
    assert table.candidates(asked) == []
    table.load(rows_of(spark, 1, [1]))
    assert [r.v for r in table.lookup(asked).collect()] == [1.0] and table.lookup(asked.limit(0)).count() == 0
