import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyglass.operators import cleaning, profile
from tallyglass.plans import daily
from tallyglass.schema import TRANSACTION_SCHEMA, wide_transaction_schema
from tallyglass.sources import backlog, transactions

RAW = """# transaction_id | tx_datetime | customer_id | terminal_id | tx_amount | tx_time_seconds | tx_time_days | tx_fraud | tx_fraud_scenario

1,2024-01-01 10:00:00,5,7,12.5,36000,0,0,0
2,2024-01-01 24:00:00,5,7,12.5,86400,0,0,0
3,2024-01-02 10:00:00,0,7,12.5,122400,1,0,0
4,2024-01-02 11:00:00,5,7,-1.0,126000,1,0,0
5,2024-01-02 12:00:00,5,7,,129600,1,1,2
6,2024-01-02 13:00:00,5,7,3.5,133200,1,1,2
"""


@pytest.fixture
def raw(spark, tmp_path):
    (tmp_path / "2024-01-01.txt").write_text(RAW)
    return transactions.read_transactions(spark, str(tmp_path))


def test_text_rules(raw):
    assert raw.count() == 6
    assert [r.transaction_id for r in cleaning.clean(raw).orderBy("transaction_id").collect()] == [1, 6]
    counts = cleaning.reject_counts(raw).first()
    assert (counts.total, counts.not_positive, counts.some_null, counts.clean) == (6, 3, 1, 2)


def test_corrupt_lines_can_be_kept(spark, tmp_path):
    (tmp_path / "a.txt").write_text(RAW)
    rows = transactions.read_transactions(spark, str(tmp_path), keep_corrupt=True).cache()
    assert rows.filter(F.col(transactions.CORRUPT).isNotNull()).count() == 2  # header and the 24:00:00 line


def test_load_by_day_reads_all_files_and_missing_path_raises(spark, tmp_path):
    for day in (1, 2, 3):
        (tmp_path / f"2024-01-0{day}.txt").write_text(f"{day},2024-01-0{day} 10:00:00,5,7,1.5,0,0,0,0\n")
    rows = transactions.load(spark, str(tmp_path))
    assert [r.date for r in cleaning.days(rows).collect()] == [dt.date(2024, 1, d) for d in (1, 2, 3)]
    assert transactions.load(spark, str(tmp_path), transactions.LoadingMethod.FULL_DATASET).columns == TRANSACTION_SCHEMA.fieldNames()
    keyed = transactions.read_with_file_key(spark, str(tmp_path))
    assert {r.file_key for r in keyed.collect()} == {"2024-01-01", "2024-01-02", "2024-01-03"}
    assert {r.key for r in transactions.list_files(spark, str(tmp_path)).collect()} == {"2024-01-01", "2024-01-02", "2024-01-03"}
    with pytest.raises(Exception):
        transactions.load(spark, str(tmp_path / "absent")).count()


def test_day_filter_reaches_the_scan(spark, sf_dir):
    plan = cleaning.day_slice(spark.read.parquet(f"{sf_dir}/events.parquet"), "2024-01-02", "ts")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_backlog(spark):
    keys = lambda *names: spark.createDataFrame([(n,) for n in names], "key string")
    inputs = keys("b", "a", "d", "c")
    assert [r.key for r in backlog.next_unprocessed(inputs, keys("a", "b")).collect()] == ["c"]
    assert [r.key for r in backlog.next_unprocessed(inputs, keys()).collect()] == ["a"]
    assert backlog.next_unprocessed(inputs, keys("d")).count() == 0
    assert [r.key for r in backlog.next_unprocessed(inputs, keys("bb")).collect()] == ["c"]  # not an input
    assert sorted(r.key for r in backlog.unprocessed(inputs, keys("a", "c")).collect()) == ["b", "d"]
    stems = spark.createDataFrame([("s3a://x/y/2024-01-01.txt",), ("/tmp/part",)], "p string")
    assert [r[0] for r in stems.select(backlog.file_stem(F.col("p"))).collect()] == ["2024-01-01", "part"]


def test_profile_of_edge_columns(spark):
    rows = spark.createDataFrame([(1, 5, None), (2, 5, 0.0), (3, 5, 0.0)], "a int, b int, c double")
    table = {r.column: r for r in profile.profile(rows).collect()}
    assert table["b"].skewness is None and table["b"].std == 0.0 and table["b"]["max"] == 5.0
    assert table["c"].mean == 0.0 and table["c"]["min"] == 0.0  # a zero stays a zero
    assert table["c"].non_null_ratio == pytest.approx(2 / 3) and table["c"].missing_ratio == pytest.approx(1 / 3)
    assert table["c"].duplicates_ratio == pytest.approx(1 / 3)  # null counts as one value
    corr = {(r.col_a, r.col_b): r["corr"] for r in profile.correlation(rows).collect()}
    assert corr[("a", "a")] == 1.0 and corr[("a", "b")] is None
    empty = rows.filter("a > 9")
    assert profile.profile(empty, ["a"], ["b"]).count() == 0
    one = profile.profile(rows.limit(1), [], ["b"]).first()
    assert one.std == 0.0 and one.kurtosis is None


def test_constant_column_over_many_partitions(spark):
    rows = spark.range(20000).select(F.lit(7).alias("c"), F.col("id").cast("double").alias("x")).repartition(13)
    row = profile.profile(rows, [], ["c"]).first()
    assert row.std == 0.0 and row.skewness is None and row.kurtosis is None
    assert {r["corr"] for r in profile.correlation(rows, [], ["c", "x"]).collect() if r.col_a != r.col_b} == {None}


def test_profile_of_tagged_text(spark):
    rows = spark.createDataFrame([("1",), ("x",), ("3",)], "t string")
    tagged = rows.withColumn("t", F.col("t").alias("t", metadata={"numeric": True}))
    row = profile.profile(tagged).first()
    assert row.column == "t" and row.mean == 2.0 and row.non_null_ratio == pytest.approx(2 / 3)


def test_sketched_profile_shuffles_only_states(spark, sf_dir):
    from tallyglass import adapters

    rows = cleaning.with_day(adapters.transactions(spark, sf_dir))
    plan = profile.profile(rows, ["date"], approximate=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("partial_") > 5 and "Window" not in plan
    assert "partial_avg" in plan and "props" not in plan  # map-side states, unused columns not read
    exact = {(r.date, r.column): r for r in profile.profile(rows, ["date"], split_above=20).collect()}
    for r in profile.profile(rows, ["date"], approximate=True).collect():
        assert r.median == exact[(r.date, r.column)].median and r.mean == exact[(r.date, r.column)].mean


def test_calendar_skips_missing_days(spark):
    rows = spark.sql("select * from values (date'2024-01-01'), (date'2024-01-04'), (null) t(date)")
    out = [tuple(r) for r in profile.calendar(rows).orderBy("date").collect()]
    a, b = dt.date(2024, 1, 1), dt.date(2024, 1, 4)
    assert out == [(a, None, b), (b, a, None)]


def test_approximate_distinct_is_close(spark):
    rows = spark.range(10000).select((F.col("id") % 500).alias("v"), F.lit(1).alias("g"))
    row = profile.distinct_counts(rows, ["g"], ["v"], approximate=True).first()
    assert abs(row.distinct_values - 500) < 50


def test_wide_schema_keeps_names():
    assert wide_transaction_schema().fieldNames() == TRANSACTION_SCHEMA.fieldNames()


def test_next_file_job(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    for day in (1, 2, 3):
        (raw / f"2024-01-0{day}.txt").write_text(f"{day},2024-01-0{day} 10:00:00,5,7,1.5,0,0,0,0\n9,,,,,,,,\n")
    done = [daily.clean_next(spark, str(raw), out) for _ in range(4)]
    assert done == ["2024-01-01", "2024-01-02", "2024-01-03", None]
    assert spark.read.parquet(out).count() == 3
    (raw / "2023-12-31.txt").write_text("8,2023-12-31 10:00:00,5,7,1.5,0,0,0,0\n")
    assert daily.clean_next(spark, str(raw), out) is None  # behind the mark
    assert daily.clean_next(spark, str(raw), out, backfill=True) == "2023-12-31"


@pytest.mark.parametrize("backfill", [False, True])
def test_a_rejected_file_does_not_stall_the_job(spark, tmp_path, backfill):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    (raw / "2024-01-01.txt").write_text("1,2024-01-01 10:00:00,5,7,-1.5,0,0,0,0\n")
    (raw / "2024-01-02.txt").write_text("2,2024-01-02 10:00:00,5,7,1.5,0,0,0,0\n")
    done = [daily.clean_next(spark, str(raw), out, backfill=backfill) for _ in range(3)]
    assert done == ["2024-01-01", "2024-01-02", None]
    assert [r.transaction_id for r in spark.read.parquet(out).collect()] == [2]
