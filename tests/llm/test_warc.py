import hashlib

import pytest

from tallyglass.llm import warc
from tests.llm.helpers import frame

SCHEMA = "page_id bigint, url string, html string"


def expected(rows):
    data = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for page, payload in data:
        heads = [p for p, other in data if other == payload and p is not None]
        head = max(heads, default=None)
        revisit = len(payload) >= 1000 and page is not None and head is not None and page < head
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/", "x" * 1000),
    (2, "http://b/ with blank\r\nand line", "x" * 1000),
    (3, None, "x" * 1000),
    (3, "http://again/", "x" * 1000),
    (4, "", "short"),
    (5, "http://c/", "short"),
    (6, "http://n/", None),
    (None, "http://no-id/", "x" * 1000),
    (7, "http://trap/", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 20),
    (8, "http://long/é", "é" * 300_000),
]


def test_round_trip_and_revisits(spark, tmp_path):
    pages = frame(spark, ROWS, SCHEMA).repartition(3)
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = warc.op1_warc(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(ROWS)


def test_addresses_and_payloads_come_back(spark, tmp_path):
    warc.write(warc.records(frame(spark, ROWS, SCHEMA)), str(tmp_path / "w"))
    back = {(r.page_id, r.target_uri): r for r in warc.read(spark, str(tmp_path / "w")).collect()}
    for page, url, html in ROWS:
        r = back[page, url]
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == (html or "").encode()


def test_filters_are_pushed_and_payloads_skipped(spark, tmp_path):
    warc.write(warc.records(frame(spark, ROWS, SCHEMA)), str(tmp_path / "w"))
    rows = warc.read(spark, str(tmp_path / "w"), payload=False).filter("record_type = 'revisit' and page_id >= 2")
    assert [(r.page_id, r.refers_to, r.payload) for r in rows.collect()] == [(2, 3, None)]
    reader = warc.WarcReader(str(tmp_path / "w"), True)
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload",), b"")]))
    assert len(left) == 1 and reader.tests == [("record_type", "eq", "revisit")]


def test_large_files_are_split_at_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SPLIT_BYTES", 2000)
    warc.WarcWriter(str(tmp_path / "w"))
    message = _write_here(warc.WarcWriter(str(tmp_path / "w")), 40)
    reader = warc.WarcReader(str(tmp_path / "w"), True)
    parts = reader.partitions()
    assert len(parts) == len(message.starts) > 3
    found = [r["page_id"] for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert found == list(range(40))


def _write_here(writer, n):
    import pyarrow as pa

    rows = [{"record_id": None, "record_type": "response", "page_id": i, "target_uri": "u", "refers_to": None, "payload_digest": "d", "payload_length": 100, "payload": b"p" * 100} for i in range(n)]
    message = writer.write(iter([pa.RecordBatch.from_pylist(rows)]))
    writer.commit([message, None])
    return message


def test_uncommitted_files_are_not_read(spark, tmp_path):
    writer = warc.WarcWriter(str(tmp_path / "w"))
    _write_here(writer, 3)
    import pyarrow as pa

    writer.write(iter([pa.RecordBatch.from_pylist([{"record_type": "response", "page_id": 99, "payload": b""}])]))
    assert warc.read(spark, str(tmp_path / "w")).count() == 3


def test_empty_table(spark, tmp_path):
    warc.write(warc.records(frame(spark, [], SCHEMA)), str(tmp_path / "w"))
    assert warc.read(spark, str(tmp_path / "w")).count() == 0


def test_foreign_archive_without_manifest(spark, tmp_path):
    (tmp_path / "w").mkdir()
    body = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "w" / "x.warc").write_bytes(body * 2)
    rows = warc.read(spark, str(tmp_path / "w")).collect()
    assert [(r.record_type, bytes(r.payload)) for r in rows] == [("warcinfo", b"hello")] * 2


def test_damaged_archive_is_an_error(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "x.warc").write_bytes(b"not an archive\r\n\r\n")
    with pytest.raises(Exception, match="no WARC record"):
        warc.read(spark, str(tmp_path / "w")).collect()
