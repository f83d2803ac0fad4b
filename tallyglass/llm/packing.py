"""Packing documents into fixed windows by the online sum-of-squares rule.

A document is its token ids and an end id. Whole windows are cut off its front; the rest is one item. Each
item goes to the open fill level where the sum over levels of the squared number of windows at that level
becomes smallest; the levels' counts are one array. When a task ends, the windows still open are drained:
their pieces refill windows, cut where needed, and the last remainder is laid out in windows whose length is
a power of two, which need no padding.

Every task packs the documents of its input split and no row moves. Memory is one array of 1024 counts, the
pieces of open windows and one batch of texts of 4 MB. A task that runs again reads the same split and so gives the
same windows.

Null texts count as empty and give the end id alone. Rows that repeat a document id are packed like any
other. An empty table gives no pieces. Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.llm.common import bounded_batches, releasing, table
from tallyglass.llm.textids import SpacedUnits, units_of

WINDOW = 1024
END_ID = 0
FLUSH_PIECES = 4096
FLUSH_IDS = 1_000_000
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


class LevelArray:
    """Open windows by fill level, and the rule that chooses one."""

    def __init__(self, window: int, first_id: int):
        import numpy as np

        self.window, self.next_id = window, first_id
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[tuple[int, list]]] = [[] for _ in range(window + 1)]

    def level_for(self, size: int) -> int:
        """Level to put ``size`` on; 0 opens a window. Fullest level first among ties.

        Moving a window from level h to h + size changes the sum of squares by
        2 * (count[h + size] - count[h]) + 2; opening one changes it by 2 * count[size] + 1, filling one up by
        1 - 2 * count[h].
        """
        import numpy as np

        top = self.window - size
        change = np.full(top + 1, np.iinfo(np.int64).max)
        change[0] = 2 * self.count[size] + 1 if size < self.window else 0
        if top:
            have = self.count[1 : top + 1]
            gain = 2 * (self.count[size + 1 : self.window + 1] - have) + 2
            gain[-1] = 1 - 2 * have[-1]
            change[1:] = np.where(have > 0, gain, change[1:])
        return int(top - np.argmin(change[::-1]))

    def place(self, piece: tuple, size: int) -> tuple[int, list] | None:
        """Put a piece; returns the window's id and pieces if it is now full."""
        level = self.level_for(size)
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        else:
            window = (self.next_id, [])
            self.next_id += 1
        window[1].append(piece)
        if level + size == self.window:
            return window
        self.open[level + size].append(window)
        self.count[level + size] += 1
        return None

    def drain(self) -> Iterator[tuple[int, list]]:
        """Pieces of all open windows, re-cut into full windows and windows of a power of two."""
        pieces = [p for level in reversed(self.open) for window in level for p in window[1]]
        left = sum(p[2] for p in pieces)
        room, held = 0, []
        for doc, start, length, ids, total in pieces:
            at = 0
            while at < length:
                if room == 0:
                    if held:
                        yield self.next_id, held
                        self.next_id += 1
                    held, room = [], min(self.window, 1 << (left.bit_length() - 1))
                take = min(room, length - at)
                held.append((doc, start + at, take, ids[4 * at : 4 * (at + take)], total))
                at, room, left = at + take, room - take, left - take
        if held:
            yield self.next_id, held
            self.next_id += 1


def pack_split(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, window: int) -> Iterator[pa.RecordBatch]:
    import numpy as np

    units = units_of(SpacedUnits, tokenizer)
    levels = LevelArray(window, TaskContext.get().partitionId() << 40)
    end = np.array([end_id], "<u4").tobytes()
    rows: list[tuple] = []
    held = 0

    def emit(window_id: int, pieces: list) -> None:
        nonlocal held
        offset = 0
        for doc, start, length, ids, total in pieces:
            rows.append((doc, start, length, ids, total, window_id, offset))
            offset += length
        held += offset

    def full_batch() -> bool:
        return len(rows) >= FLUSH_PIECES or held >= FLUSH_IDS

    def flush() -> pa.RecordBatch:
        nonlocal held
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        rows.clear()
        held = 0
        return batch

    for batch in batches:
        for doc, text in zip(batch.column("doc_id"), batch.column("text")):
            ids = units.ids(text.as_py() or "") + end
            total, doc, start = len(ids) // 4, doc.as_py(), 0
            while total - start >= window:
                emit(levels.next_id, [(doc, start, window, ids[4 * start : 4 * (start + window)], total)])
                levels.next_id += 1
                start += window
            if start < total and (full := levels.place((doc, start, total - start, ids[4 * start :], total), total - start)):
                emit(*full)
            if full_batch():
                yield flush()
    for window_id, pieces in levels.drain():
        emit(window_id, pieces)
        if full_batch():
            yield flush()
    if rows:
        yield flush()


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit numbers), window and place in the window."""
    bounded_batches(docs.sparkSession)
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches):
        yield from releasing(pack_split(batches, path, end_id, window))

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def pieces_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_digest(pack(table(spark, sf_dir, "documents")))


QUERIES = {"op2_pack": op2_pack}
ORACLE: dict[str, str] = {}
