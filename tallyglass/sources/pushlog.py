"""Push source: an append-only log of pushed rows, and the streaming data source that reads it.

A push writes its rows as Parquet files and then commits their names under the next number (``commitlog``). The
number is the stream's offset: a micro-batch is a range of numbers, so a batch that is lost and planned again reads the
same files. Every file is a partition of its batch. ``segments`` limits the pushes of one micro-batch. What a stream
has committed is kept in ``_readers`` under the stream's ``reader`` name, if it has one; ``expired`` lists what all
named readers have passed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tallyglass.sources.commitlog import CommitLog, list_files, open_folder

FORMAT = "push_log"
BATCH_ROWS = 65_536


@dataclass(frozen=True)
class PushLog:
    """The writing side."""

    spark: SparkSession
    path: str

    def _log(self) -> CommitLog:
        return CommitLog(f"{self.path}/_log", self.spark)

    def push(self, rows: DataFrame, key: str | None = None) -> int | None:
        """Append rows as one segment and return its number.

        A push that repeats the ``key`` of an earlier one adds nothing and returns None, so that a producer may retry.
        """
        log = self._log()
        if key is not None and any(e.get("key") == key for _, e in log.entries()):
            return None
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        files = [{"file": f"{folder}/{f.base_name}", "bytes": f.size} for f in list_files(f"{self.path}/{folder}")]

        def build(_: int) -> dict | None:
            taken = key is not None and any(e.get("key") == key for _, e in log.entries())
            return None if taken else {"files": files, "key": key}

        return log.commit(build)

    def latest(self) -> int:
        return self._log().latest()

    def files(self, after: int = 0, until: int | None = None) -> list[str]:
        return [f["file"] for _, e in self._log().entries(after, until) for f in e["files"]]

    def read(self, schema: T.StructType, after: int = 0, until: int | None = None) -> DataFrame:
        """The same rows as a batch."""
        files = [f"{self.path}/{f}" for f in self.files(after, until)]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def expired(self) -> list[str]:
        """Files that every named reader has passed; none without a named reader."""
        passed = [json.loads(_read(f"{self.path}/_readers", f.base_name))["segment"] for f in list_files(f"{self.path}/_readers")]
        return self.files(0, min(passed)) if passed else []


def _read(folder: str, name: str) -> bytes:
    system, plain = open_folder(folder)
    with system.open_input_file(f"{plain}/{name}") as file:
        return file.read()


@dataclass
class LogFile(InputPartition):
    file: str


class PushLogReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path = options["path"]
        self.limit = int(options.get("segments", 0))
        self.reader = options.get("reader")
        self.schema = schema
        self.planned = 0

    def _log(self) -> CommitLog:
        return CommitLog(f"{self.path}/_log")

    def initialOffset(self) -> dict:
        return {"segment": 0}

    def latestOffset(self) -> dict:
        """The last committed segment, or ``segments`` after the last planned one.

        A restarted stream learns its place first: Spark plans the empty range behind the last offset it has seen.
        """
        latest = self._log().latest()
        return {"segment": min(latest, self.planned + self.limit) if self.limit else latest}

    def partitions(self, start: dict, end: dict) -> list[LogFile]:
        if end["segment"] < start["segment"]:
            raise RuntimeError(f"the stream went back from push {start['segment']} to {end['segment']}")
        self.planned = max(self.planned, end["segment"])
        return [LogFile(f["file"]) for _, e in self._log().entries(start["segment"], end["segment"]) for f in e["files"]]

    def commit(self, end: dict) -> None:
        if self.reader:
            system, plain = open_folder(f"{self.path}/_readers")
            system.create_dir(plain, recursive=True)
            with system.open_output_stream(f"{plain}/{self.reader}") as file:
                file.write(json.dumps(end).encode())

    def read(self, partition: LogFile) -> Iterator[pa.RecordBatch]:
        layout = to_arrow_schema(self.schema)
        system, plain = open_folder(self.path)
        with system.open_input_file(f"{plain}/{partition.file}") as file:
            for batch in pq.ParquetFile(file).iter_batches(BATCH_ROWS, columns=self.schema.names):
                if batch.num_rows:
                    table = pa.Table.from_batches([batch]).select(self.schema.names).cast(layout)
                    yield from table.to_batches()


class PushLogSource(DataSource):
    """``spark.readStream.format("push_log").schema(...).option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("a push log is read with the schema of its rows")

    def streamReader(self, schema: T.StructType) -> PushLogReader:
        return PushLogReader(dict(self.options), schema)


def stream(
    spark: SparkSession, path: str, schema: T.StructType, segments: int | None = None, reader: str | None = None
) -> DataFrame:
    """Pushed rows as a stream; ``segments`` limits the pushes that one micro-batch takes."""
    spark.dataSource.register(PushLogSource)
    source = spark.readStream.format(FORMAT).schema(schema).option("path", path)
    if segments:
        source = source.option("segments", str(segments))
    return (source.option("reader", reader) if reader else source).load()
