"""Shared helpers: input tables, files in the shared folder, slices of Arrow batches, what Python workers keep."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

SLICE_CHARS = 4_000_000
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of 4 MB, or one row, at most in this session. Spark's 64 MB are held by each task several times:
    in buffers beside the JVM's heap, which double as they grow, and in the Python worker."""
    digits, unit = re.match(r"(-?\d+)([kmgtp]?)", spark.conf.get(BATCH_SETTING).strip().lower()).groups()
    now = int(digits) << 10 * (" kmgtp".index(unit) if unit else 0)
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a shared path; any scheme that pyarrow knows, or a mounted folder."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def read_bytes(path: str, start: int = 0, length: int | None = None) -> bytes:
    system, plain = filesystem(path)
    with system.open_input_file(plain) as file:
        if length is None:
            length = file.size() - start
        return file.read_at(length, start)


_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]):
    """What ``make`` gives, once per Python worker. Spark hands workers from stage to stage, so only the last key stays."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
        release_memory()
    return _kept[key]


def release_memory() -> None:
    """Give freed memory back to the system; a worker that waits for its next task holds it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def releasing(rows: Iterator) -> Iterator:
    """``rows``; memory is released when they end."""
    try:
        yield from rows
    finally:
        release_memory()


def slices(batch: pa.RecordBatch | None, sizes: list[int], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose sizes add up to at most ``most``, or single rows."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > most:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)
