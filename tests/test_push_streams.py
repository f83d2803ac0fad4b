"""Commit log, push log, typed keyed state, stream-stream point-in-time features."""

import datetime as dt
import json
import os
import threading

import pytest

from tallyglass.operators.asof import FeatureTable, asof_join, latest_per_key
from tallyglass.sources import featurestore
from tallyglass.sources.commitlog import CommitLog
from tallyglass.sources.pushlog import PushLog, PushLogReader, stream
from tallyglass.streaming import jobs, state

T0 = dt.datetime(2024, 1, 1)
STATS = "driver_id int, event_timestamp timestamp_ntz, created timestamp_ntz, v double"
REQUESTS = "event_id int, driver_id int, event_timestamp timestamp_ntz"
HOUR, DAY = dt.timedelta(hours=1), dt.timedelta(days=1)
AT_ONCE = {"processingTime": "0 seconds"}


def stats(spark, rows):
    return spark.createDataFrame([(k, t, c, v) for k, t, c, v in rows], STATS).coalesce(1)


def pushed(spark, path, parts, schema=STATS):
    log = PushLog(spark, str(path))
    for part in parts:
        log.push(spark.createDataFrame(part, schema).coalesce(1))
    return log


def test_each_number_is_committed_once(tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    assert log.latest() == 0 and log.entries() == []
    taken, tries = [], []

    def write(writer):
        for i in range(25):
            taken.append(log.commit(lambda version: tries.append(version) or {"writer": writer, "i": i, "version": version}))

    threads = [threading.Thread(target=write, args=(w,)) for w in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(taken) == list(range(1, 101)) and len(tries) >= 100
    assert [v for v, _ in log.entries()] == list(range(1, 101))
    assert all(content["version"] == v for v, content in log.entries())
    assert len({(c["writer"], c["i"]) for _, c in log.entries()}) == 100
    assert log.commit(lambda version: None) is None and log.latest() == 100
    assert [v for v, _ in log.entries(97, 99)] == [98, 99]
    assert sorted(os.listdir(tmp_path / "log"))[0].endswith("1.json")  # no drafts are left


def test_push_is_repeatable_and_read_in_batches(spark, tmp_path):
    log = PushLog(spark, str(tmp_path / "log"))
    rows = stats(spark, [(1, T0, T0, 1.0), (2, T0, None, None)])
    assert log.push(rows, "a") == 1 and log.push(rows, "a") is None
    assert log.push(rows.limit(0), "empty") == 2
    assert log.push(stats(spark, [(None, None, T0, 3.0)]), "b") == 3
    assert log.read(rows.schema).count() == 3 and log.read(rows.schema, 1, 2).count() == 0
    history, checkpoint = str(tmp_path / "h"), str(tmp_path / "s")
    query = jobs.push_features(stream(spark, log.path, rows.schema, 1, "me"), checkpoint, ["driver_id"], history, trigger=AT_ONCE)
    jobs.drain(query)
    assert sorted(os.listdir(f"{checkpoint}/commits"))[-1] == "2"  # one push, one micro-batch
    got = {tuple(r) for r in featurestore.read_history(spark, history).collect()}
    assert got == {(1, T0, T0, 1.0), (2, T0, None, None), (None, None, T0, 3.0)}
    log.push(stats(spark, [(9, T0, T0, 9.0)]), "c")
    again = stream(spark, log.path, rows.schema, 1, "me")
    jobs.drain(jobs.push_features(again, checkpoint, ["driver_id"], history, trigger=AT_ONCE))
    assert featurestore.read_history(spark, history).count() == 4  # only the new push was read
    assert json.loads((tmp_path / "log" / "_readers" / "me").read_text())["segment"] >= 3
    assert set(log.expired()) <= set(log.files())


def test_lost_batch_reads_the_same_rows(spark, tmp_path):
    parts = [[(i, T0, T0, float(i))] for i in range(4)]
    log = pushed(spark, tmp_path / "log", parts)
    schema = spark.createDataFrame([], STATS).schema
    seen, checkpoint = [], str(tmp_path / "s")

    def start(source):
        def write(batch, number):
            seen.append((number, sorted(r.driver_id for r in batch.collect())))

        return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**AT_ONCE).start()

    jobs.drain(start(stream(spark, log.path, schema, 2)))
    assert seen == [(0, [0, 1]), (1, [2, 3])]
    # The last batch was planned and its writer ran, but its commit got lost; meanwhile more rows came.
    for name in ("1", ".1.crc"):
        path = os.path.join(checkpoint, "commits", name)
        if os.path.exists(path):
            os.remove(path)
    log.push(spark.createDataFrame([(9, T0, T0, 9.0)], STATS))
    jobs.drain(start(stream(spark, log.path, schema, 2)))
    assert seen[2:] == [(1, [2, 3]), (2, [9])]


def test_reader_limits_only_what_it_has_planned(spark, tmp_path):
    log = pushed(spark, tmp_path / "log", [[(i, T0, T0, 0.0)] for i in range(5)])
    reader = PushLogReader({"path": log.path, "segments": "2"}, spark.createDataFrame([], STATS).schema)
    assert reader.initialOffset() == {"segment": 0} and reader.latestOffset() == {"segment": 2}
    files = reader.partitions({"segment": 0}, {"segment": 2})
    assert len(files) == 2 and reader.latestOffset() == {"segment": 4}
    assert files == reader.partitions({"segment": 0}, {"segment": 2})
    assert sum(b.num_rows for f in files for b in reader.read(f)) == 2
    restarted = PushLogReader({"path": log.path, "segments": "2"}, reader.schema)
    assert restarted.partitions({"segment": 3}, {"segment": 3}) == [] and restarted.latestOffset() == {"segment": 5}
    with pytest.raises(RuntimeError):
        restarted.partitions({"segment": 3}, {"segment": 1})


def run_state(spark, log, checkpoint, seen=None, **options):
    schema = spark.createDataFrame([], STATS).schema

    def write(batch, number):
        rows = [tuple(r) for r in batch.collect()]
        if seen is not None:
            seen.extend(rows)

    changes = state.newest_changes(stream(spark, log.path, schema, 1), ["driver_id"], **options)
    jobs.drain(state.start_changes(changes, checkpoint, write, **AT_ONCE))
    return {tuple(r) for r in state.read_newest(spark, checkpoint).collect()}


def test_newest_row_in_state_survives_a_restart(spark, tmp_path):
    parts = [
        [(1, T0, T0, 1.0), (2, T0, T0, 2.0), (3, None, T0, 0.0), (None, T0, T0, 7.0)],
        [(1, T0 + HOUR, T0, 3.0), (1, T0 + HOUR, None, 9.0), (2, T0 - HOUR, T0 + DAY, 0.0)],
        [(2, T0, T0 + HOUR, 4.0), (2, T0, T0 + HOUR, float("nan")), (2, T0, T0 + HOUR, None)],
    ]
    log, checkpoint = pushed(spark, tmp_path / "log", parts[:2]), str(tmp_path / "state")
    before = spark.conf.get(state.PROVIDER, None)
    assert run_state(spark, log, checkpoint) == {(1, T0 + HOUR, T0, 3.0), (2, T0, T0, 2.0), (None, T0, T0, 7.0)}
    assert spark.conf.get(state.PROVIDER, None) == before
    log.push(spark.createDataFrame(parts[2], STATS))
    found = run_state(spark, log, checkpoint)
    expected = latest_per_key(spark.createDataFrame(sum(parts, []), STATS).filter("event_timestamp is not null"), ["driver_id"])
    assert sorted(map(repr, found)) == sorted(repr(tuple(r)) for r in expected.collect())


def test_expired_keys_leave_the_state(spark, tmp_path):
    parts = [[(1, T0, T0, 1.0), (2, T0, T0, 2.0)], [(2, T0 + 3 * DAY, T0, 3.0)], [(3, T0 + 6 * DAY, T0, 4.0)], [(1, T0 + DAY, T0, 5.0)]]
    log, seen = pushed(spark, tmp_path / "log", parts), []
    found = run_state(spark, log, str(tmp_path / "state"), seen, ttl=DAY, delay="1 day")
    # The watermark ends at day 5: key 1 went at day 2, key 2 at day 4, and the last row is too late to come back.
    assert found == {(3, T0 + 6 * DAY, T0, 4.0)}
    assert {r for r in seen if r[-1]} == {(1, T0, T0, 1.0, True), (2, T0 + 3 * DAY, T0, 3.0, True)}
    assert (1, T0 + DAY, T0, 5.0, False) not in seen


def test_processing_time_keeps_without_watermark(spark, tmp_path):
    parts = [[(1, T0 + 9 * DAY, T0, 1.0)], [(2, T0, T0, 2.0)]]
    log, checkpoint = pushed(spark, tmp_path / "log", parts), str(tmp_path / "state")
    rows = stream(spark, log.path, spark.createDataFrame([], STATS).schema)
    changes = state.newest_changes(rows, ["driver_id"], event_time=False, ttl=DAY)
    state.start_changes(changes, checkpoint, lambda batch, number: batch.count()).awaitTermination(60)
    found = {tuple(r) for r in state.read_newest(spark, checkpoint).collect()}
    assert found == {(1, T0 + 9 * DAY, T0, 1.0), (2, T0, T0, 2.0)}


@pytest.mark.parametrize("batches", [1, 3])
def test_streamed_features_equal_the_batch_join(spark, tmp_path, batches):
    import random

    rng = random.Random(batches)
    facts = [(rng.randrange(4), T0 + HOUR * rng.randrange(240), T0 + HOUR * rng.randrange(3), rng.random()) for _ in range(120)]
    asked = [(i, rng.randrange(5), T0 + HOUR * rng.randrange(240)) for i in range(80)]
    asked += [(900, 1, facts[0][1] + 2 * DAY), (901, None, T0 + DAY)]
    facts.append((1, facts[0][1], T0, 5.0))  # exactly as old as the time-to-live allows
    end = T0 + 4000 * DAY
    cut = [T0 + HOUR * (240 * (i + 1) // batches) for i in range(batches - 1)] + [end]

    def slices(rows, at):
        out, low = [], dt.datetime.min
        for high in cut:
            out.append([r for r in rows if low <= r[at] < high])
            low = high
        return out

    f = pushed(spark, tmp_path / "f", slices(facts, 1) + [[(-1, end, None, None)]])
    q = pushed(spark, tmp_path / "q", slices(asked, 2) + [[(-1, -1, end)]], REQUESTS)
    schemas = [spark.createDataFrame([], s).schema for s in (REQUESTS, STATS)]
    joined = state.asof_stream(
        stream(spark, q.path, schemas[0], 1), stream(spark, f.path, schemas[1], 1), ["driver_id"], ["event_id"], ["v"], 2 * DAY
    )
    got = jobs.run_to_table(joined, str(tmp_path / "out"), str(tmp_path / "state"), AT_ONCE)
    table = FeatureTable(spark.createDataFrame(facts, STATS), {"v": ("v", 2 * DAY)})
    expected = asof_join(spark.createDataFrame(asked, REQUESTS), [table], ["driver_id"])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, expected.collect())))


def test_late_rows_are_dropped(spark, tmp_path):
    end = T0 + 90 * DAY
    f = pushed(spark, tmp_path / "f", [[(1, T0, T0, 1.0)], [(1, T0 + 9 * DAY, T0, 2.0)], [(2, T0 + 9 * DAY, T0, 8.0)], [(1, T0 + 4 * DAY, T0, 3.0)], [(-1, end, None, None)]])
    q = pushed(
        spark, tmp_path / "q",
        [[(1, 1, T0 + DAY)], [(2, 1, T0 + 10 * DAY)], [(5, 2, T0 + 10 * DAY)], [(3, 1, T0 + 5 * DAY), (4, 1, T0 + 9 * DAY + HOUR)], [(-1, -1, end)]], REQUESTS,
    )
    schemas = [spark.createDataFrame([], s).schema for s in (REQUESTS, STATS)]
    joined = state.asof_stream(
        stream(spark, q.path, schemas[0], 1), stream(spark, f.path, schemas[1], 1), ["driver_id"], ["event_id"], ["v"], 2 * DAY
    )
    got = jobs.run_to_table(joined, str(tmp_path / "out"), str(tmp_path / "state"), AT_ONCE)
    # Request 3 and the feature row of day 4 come after the watermark (day 8) has passed them. A watermark holds from the
    # micro-batch after the one that moved it.
    assert {(r.event_id, r.v) for r in got.collect()} == {(1, 1.0), (2, 2.0), (4, 2.0), (5, 8.0)}
