"""WARC archives as a Spark data source.

The writer stores one uncompressed WARC/1.1 record per row and, in a manifest, the offset of a record every
few megabytes. The reader plans one partition per stretch between those offsets (whole files where there is
no manifest), parses the header of each record first, applies pushed predicates to header fields and seeks
over payloads that are refused or not asked for. Files get attempt-unique names and only a committed
manifest names them, so a task that runs twice leaves nothing that a reader sees.

Null payloads are written empty; a null page id or address leaves its header out and reads back as null.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSelector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from tallyglass.llm.common import filesystem, read_bytes, table
from tallyglass.workspace import checked_broadcast, scratch_path

SCHEMA = (
    "record_id string, record_type string, page_id bigint, target_uri string, refers_to bigint, "
    "payload_digest string, payload_length bigint, payload binary"
)
ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
SPLIT_BYTES = 32 << 20
BATCH_BYTES = 8 << 20
MIN_REVISIT_BYTES = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Record header of each column; the X- fields carry what the standard has no field for.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "page_id": "X-Page-ID",
    "target_uri": "WARC-Target-URI",
    "refers_to": "X-Refers-To-Page-ID",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
}
COLUMN_OF = {header.lower(): column for column, header in HEADERS.items()}
WHOLE = ("page_id", "refers_to", "payload_length")


@dataclass
class Written(WriterCommitMessage):
    name: str
    size: int
    records: int
    starts: list[int]


@dataclass
class Stretch(InputPartition):
    path: str
    start: int
    end: int


def _escaped(value: object) -> str:
    """One header line: percent signs, line ends and edge blanks of free text are percent-coded."""
    text = str(value).replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    if text[:1] in (" ", "\t") or text[-1:] in (" ", "\t"):
        text = text.replace(" ", "%20").replace("\t", "%09")
    return text


def _plain(text: str) -> str:
    for code, char in (("%0D", "\r"), ("%0A", "\n"), ("%20", " "), ("%09", "\t"), ("%25", "%")):
        text = text.replace(code, char)
    return text


def record_bytes(row: dict) -> bytes:
    revisit = row["record_type"] == "revisit"
    block = b"" if revisit else HTTP_HEAD + (row["payload"] or b"")
    lines = ["WARC/1.1", "WARC-Date: 1970-01-01T00:00:00Z"]
    for column, header in HEADERS.items():
        value = row.get(column)
        if column == "record_id":
            value = value or f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row.get("page_id")}:{row.get("payload_digest")}')}>"
        if value is not None:
            value = f"sha1:{value}" if column == "payload_digest" else value
            lines.append(f"{header}: {_escaped(value) if column == 'target_uri' else value}")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, plain = filesystem(self.path)
        system.create_dir(plain, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc"
        starts, at, next_start, records = [], 0, 0, 0
        with system.open_output_stream(f"{plain}/{name}") as out:
            for batch in iterator:
                for i in range(batch.num_rows):
                    if at >= next_start:
                        starts.append(at)
                        next_start = at + SPLIT_BYTES
                    data = record_bytes({c: batch.column(c)[i].as_py() for c in batch.schema.names})
                    out.write(data)
                    at += len(data)
                    records += 1
        return Written(name, at, records, starts)

    def commit(self, messages: list[Written | None]) -> None:
        files = [vars(m) for m in messages if m is not None and m.records]
        system, plain = filesystem(self.path)
        system.create_dir(plain, recursive=True)
        with system.open_output_stream(f"{plain}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files of failed jobs are in no manifest, so no reader sees them."""


class WarcReader(DataSourceReader):
    """Header fields are tested before a payload is read; ``payload=false`` never reads one."""

    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path.rstrip("/"), payload, []

    def pushFilters(self, filters):  # noqa: N802
        kinds = {EqualTo: "eq", In: "in", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and type(f) in kinds:
                self.tests.append((column, kinds[type(f)], f.value))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((column, "set", None))
            else:
                yield f

    def partitions(self):
        system, plain = filesystem(self.path)
        prefix = self.path
        found = system.get_file_info(FileSelector(plain, allow_not_found=True))
        manifests = [f for f in found if f.base_name.startswith("_manifest-")]
        out = []
        for info in manifests:
            for f in json.loads(read_bytes(f"{prefix}/{info.base_name}")):
                ends = f["starts"][1:] + [f["size"]]
                out += [Stretch(f"{prefix}/{f['name']}", a, b) for a, b in zip(f["starts"], ends)]
        if not manifests:
            out = [Stretch(f"{prefix}/{f.base_name}", 0, f.size) for f in found if f.base_name.endswith(".warc") and f.size]
        return out or [Stretch("", 0, 0)]

    def _accepts(self, fields: dict) -> bool:
        for column, kind, value in self.tests:
            have = fields.get(column)
            if have is None:
                return False
            if not (
                kind == "set"
                or (kind == "eq" and have == value)
                or (kind == "in" and have in value)
                or (kind == "gt" and have > value)
                or (kind == "ge" and have >= value)
                or (kind == "lt" and have < value)
                or (kind == "le" and have <= value)
            ):
                return False
        return True

    def read(self, partition: Stretch):
        if not partition.path:
            return
        schema = pa.schema([(c, ARROW[t]) for c, t in (f.split(" ") for f in SCHEMA.split(", "))])
        rows, held = [], 0
        system, plain = filesystem(partition.path)
        with system.open_input_file(plain) as file:
            file.seek(partition.start)
            while file.tell() < partition.end:
                fields, length = _header(file)
                body = file.tell()
                if self._accepts(fields):
                    fields["payload"] = None
                    if self.payload and fields.get("record_type") != "revisit":
                        block = file.read(length)
                        cut = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -1
                        fields["payload"] = block[cut + 4 :] if cut >= 0 else block
                        held += length
                    rows.append(fields)
                file.seek(body + length + 4)
                if held >= BATCH_BYTES or len(rows) >= 10_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _header(file) -> tuple[dict, int]:
    """Fields of the record header at the file position, which moves to the block, and the block's length."""
    start, head, step = file.tell(), b"", 2048
    while (end := head.find(b"\r\n\r\n")) < 0:
        more = file.read(step)
        if not more:
            raise ValueError(f"record header at {start} does not end")
        head, step = head + more, step * 2
    lines = head[:end].decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {start}")
    fields, length = dict.fromkeys(HEADERS), 0
    for line in lines[1:]:
        name, _, value = line.partition(":")
        value = value.strip(" ")
        if name.lower() == "content-length":
            length = int(value)
        elif (column := COLUMN_OF.get(name.lower())) is not None:
            if column in WHOLE:
                value = int(value)
            elif column == "payload_digest":
                value = value.removeprefix("sha1:")
            elif column == "target_uri":
                value = _plain(value)
            fields[column] = value
    file.seek(start + end + 4)
    return fields, length


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true")

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(pages: DataFrame) -> DataFrame:
    """One record row per page: payload, digest, and who revisits whom.

    Of pages with equal payloads of at least 1000 bytes the largest page id is the response and the others
    revisit it. Rows that repeat that id are responses too; a null page id is never a revisit. The digests
    that occur twice are joined back by a checked broadcast, else by a join whose skewed keys Spark splits.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload")).select(
        "*", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_length")
    )
    heads = (
        rows.filter(F.col("payload_length") >= MIN_REVISIT_BYTES)
        .groupBy("payload_digest", "payload_length")
        .agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    joined = rows.join(checked_broadcast(heads, "warc-heads"), ["payload_digest", "payload_length"], "left")
    revisit = F.coalesce(F.col("page_id") < F.col("head"), F.lit(False))
    return joined.select(
        F.lit(None).cast("string").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "page_id",
        "target_uri",
        F.when(revisit, F.col("head")).alias("refers_to"),
        "payload_digest",
        "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write(rows: DataFrame, path: str) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC, read them back; digests of responses come from the payloads read."""
    path = scratch_path(spark, "warc")
    write(records(table(spark, sf_dir, "pages")), path)
    back = read(spark, path)
    kept = F.col("record_type") == "response"
    return back.select(
        "page_id",
        F.when(kept, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(kept, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


QUERIES = {"op1_warc": op1_warc}
ORACLE = {
    "op1_warc": f"""
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), h as (
  select payload_digest, max(page_id) as head, count(*) as n from p
  where payload_bytes >= {MIN_REVISIT_BYTES} group by payload_digest
)
select page_id, payload_bytes, p.payload_digest,
  case when page_id < head then 'revisit' else 'response' end as record_type,
  case when page_id < head then head end as refers_to
from p left join h on p.payload_digest = h.payload_digest and n > 1
""",
}
