import datetime as dt
import os

from pyspark.sql import functions as F

from tallyglass.operators.featureviews import Entity, FeatureSource, PushSource
from tallyglass.schema import TRANSACTION_SCHEMA
from tallyglass.sources import featurestore
from tallyglass.streaming import jobs

STATS = "driver_id int, event_timestamp timestamp, created timestamp, v double"


def _line(number, day, amount=5.0):
    return f"{number},2024-01-{day:02d} 10:00:00,5,7,{amount},0,{day},0,0\n"


def test_one_file_per_batch_and_restart(spark, tmp_path):
    raw, out, state = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "state")
    raw.mkdir()
    for day in (1, 2, 3):
        (raw / f"d{day}.txt").write_text("# header\n" + _line(day, day) + _line(10 + day, day, -1.0))
    query = jobs.start_clean(jobs.stream_files(spark, str(raw), TRANSACTION_SCHEMA), out, state)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 3
    (raw / "d4.txt").write_text(_line(4, 4))
    again = jobs.run_clean(spark, str(raw), out, state)  # only the new file is read
    assert sorted(r.transaction_id for r in again.collect()) == [1, 2, 3, 4]


def test_late_rows_and_repeats(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i, (number, day) in enumerate([(1, 1), (2, 2), (2, 2), (3, 6), (6, 6), (4, 1), (5, 9)]):
        (raw / f"f{i}.txt").write_text(_line(number, day))
        os.utime(raw / f"f{i}.txt", (1_700_000_000 + i,) * 2)  # arrival order
    stream = jobs.stream_files(spark, str(raw), TRANSACTION_SCHEMA)
    table = jobs.run_to_table(jobs.daily_profile(stream, ["tx_amount"]), str(tmp_path / "p"), str(tmp_path / "ps"))
    got = {r.date: r.rows for r in table.collect()}
    # Row 4 belongs to the first day but arrives after the watermark has passed it.
    assert got == {dt.date(2024, 1, 1): 1, dt.date(2024, 1, 2): 2, dt.date(2024, 1, 6): 2}
    once = jobs.without_repeats(jobs.stream_files(spark, str(raw), TRANSACTION_SCHEMA), ["transaction_id"])
    rows = jobs.run_to_table(once, str(tmp_path / "o"), str(tmp_path / "os"))
    assert sorted(r.transaction_id for r in rows.collect()) == [1, 2, 3, 5, 6]


def test_push_writes_history_and_latest(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    parts = [[(1, t, t, 1.0), (2, t, t, 2.0)], [(1, t + dt.timedelta(hours=1), t, 3.0)], [(2, t, t + dt.timedelta(hours=2), 4.0)]]
    for part in parts:
        spark.createDataFrame(part, STATS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], STATS).schema, "parquet")
    history, latest = str(tmp_path / "history"), str(tmp_path / "latest")
    source = PushSource("push", FeatureSource("batch", history))
    jobs.push_to_source(stream, source, Entity("driver", ("driver_id",)), str(tmp_path / "state"), history, latest).awaitTermination()
    assert featurestore.read_history(spark, history).count() == 4
    newest = {r.driver_id: r.v for r in featurestore.read_latest(spark, latest, ["driver_id"]).collect()}
    assert newest == {1: 3.0, 2: 4.0}
    featurestore.compact(spark, latest, str(tmp_path / "folded"), ["driver_id"])
    folded = spark.read.parquet(str(tmp_path / "folded"))
    assert folded.count() == 2 and {r.driver_id: r.v for r in folded.collect()} == newest


def test_repeated_batch_changes_nothing(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows, path = spark.createDataFrame([(1, t, t, 1.0)], STATS), str(tmp_path / "h")
    featurestore.append_history(rows, path, 7)
    featurestore.append_history(rows, path, 7)
    featurestore.append_history(rows, path, 8)
    assert featurestore.read_history(spark, path).count() == 2


def test_source_derived_once(spark, tmp_path):
    rows = spark.range(3)
    for factor in (1, 5):
        featurestore.derive_if_absent(rows, lambda d: d.withColumn("x", F.col("id") * factor), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).agg(F.sum("x")).first()[0] == 3
