"""Token ids in a binary file format coded by a range asymmetric numeral system with a shared static table.

One frequency table for the whole corpus scales to 2^20. A file holds independent blocks of whole documents;
a block interleaves up to 1024 coder states, so encoder and decoder work on all of them in one array
operation. The list of a file's blocks (offset, size, first token, tokens, documents, CRC-32 of the coded
bytes) are the checkpoints: any block decodes alone, in any task.

Block layout, little-endian: magic "RNS1", documents, tokens, states, words (4 x u32), document ids (i64),
tokens per document (u32), final states (u64), words (u32).

Null texts count as empty. Rows that repeat a document id are coded one after the other. A null document id
sorts first. An empty table gives no file and no rows. Further columns are left out.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.llm.common import filesystem, read_bytes, slices, table
from tallyglass.llm.textids import BareUnits, units_of
from tallyglass.workspace import materialize, scratch_path

END_ID = 2
SCALE_BITS = 20
LOW = 1 << 31
LANES = 1024
BLOCK_TOKENS = 1 << 18
FILE_TOKENS = 1 << 25
MAGIC = b"RNS1"
NULL_ID = -(1 << 63)
BLOCK_SCHEMA = (
    "part int, path string, block int, offset bigint, size bigint, first_token bigint, tokens bigint, documents bigint, crc32 bigint"
)


def scaled_frequencies(counts, bits: int = SCALE_BITS):
    """Whole frequencies that add up to 2^bits, at least 1 for every symbol that occurs."""
    import numpy as np

    total = int(counts.sum())
    if not total:
        return counts.astype(np.int64)
    freq = np.where(counts > 0, np.maximum(1, counts * (1 << bits) // total), 0).astype(np.int64)
    over = int(freq.sum()) - (1 << bits)
    for s in np.argsort(-freq, kind="stable"):
        if over <= 0:
            break
        cut = min(over, int(freq[s]) - max(1, int(freq[s]) * 9 // 10))
        freq[s] -= cut
        over -= cut
    if over > 0:
        raise ValueError("more symbols than the scale has places")
    freq[int(np.argmax(freq))] -= over
    return freq


class Table:
    """Frequencies, their running sums and the symbol of every place on the scale."""

    def __init__(self, freq):
        import numpy as np

        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def encode(symbols, table: Table) -> tuple[bytes, bytes, int]:
    """Final states and words of one block, and the number of states."""
    import numpy as np

    n = len(symbols)
    lanes = max(1, min(LANES, n))
    steps = -(-n // lanes)
    freq, start = table.freq[symbols], table.start[symbols]
    x = np.full(lanes, LOW, np.uint64)
    low32, shift, bits, lift = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64(SCALE_BITS), np.uint64(63 - SCALE_BITS)
    words = []
    for step in range(steps - 1, -1, -1):
        f, s = freq[step * lanes : (step + 1) * lanes], start[step * lanes : (step + 1) * lanes]
        y = x[: len(f)]
        high = y >= (f << lift)
        if high.any():
            words.append((y[high] & low32).astype("<u4"))
            y = np.where(high, y >> shift, y)
        q = y // f
        x[: len(f)] = (q << bits) + (y - q * f) + s
    words.reverse()
    return x.astype("<u8").tobytes(), b"".join(w.tobytes() for w in words), lanes


def decode(states, words, n: int, table: Table):
    import numpy as np

    lanes = len(states)
    out = np.empty(n, np.uint32)
    x = states.astype(np.uint64)
    mask, bits, shift, low = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32), np.uint64(LOW)
    at = 0
    for step in range(-(-n // lanes) if n else 0):
        m = min(lanes, n - step * lanes)
        y = x[:m]
        slot = y & mask
        sym = table.symbol[slot]
        out[step * lanes : step * lanes + m] = sym
        y = table.freq[sym] * (y >> bits) + slot - table.start[sym]
        need = y < low
        k = int(need.sum())
        if k:
            y[need] = (y[need] << shift) | words[at : at + k]
            at += k
        x[:m] = y
    if at != len(words) or (x != low).any():
        raise ValueError("block does not decode to its start state")
    return out


def block_bytes(doc_ids, lengths, symbols, table: Table) -> bytes:
    import numpy as np

    states, words, lanes = encode(symbols, table)
    head = np.array([len(doc_ids), len(symbols), lanes, len(words) // 4], "<u4").tobytes()
    return MAGIC + head + np.array(doc_ids, "<i8").tobytes() + np.array(lengths, "<u4").tobytes() + states + words


def parse_block(data: bytes, crc: int, table: Table):
    """Document ids, tokens per document and all tokens of a block whose checksum fits."""
    import numpy as np

    if data[:4] != MAGIC or zlib.crc32(data) != crc:
        raise ValueError("damaged block")
    docs, n, lanes, n_words = np.frombuffer(data, "<u4", 4, 4).tolist()
    at = 20
    ids = np.frombuffer(data, "<i8", docs, at)
    lengths = np.frombuffer(data, "<u4", docs, at := at + 8 * docs)
    states = np.frombuffer(data, "<u8", lanes, at := at + 4 * docs)
    words = np.frombuffer(data, "<u4", n_words, at + 8 * lanes).astype(np.uint64)
    return ids, lengths, decode(states, words, n, table)


def tokens(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Document id, number of ids with the end id, and the ids as unsigned 16-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        units = units_of(BareUnits, tokenizer)
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(batch, pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                out = []
                for text in texts.slice(a, b - a):
                    ids = np.frombuffer(units.ids(text.as_py() or ""), "<u4")
                    out.append(np.append(ids, end_id).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array([len(x) // 2 for x in out], pa.int64()), pa.array(out, pa.binary())],
                    ["doc_id", "n_tokens", "ids"],
                )

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary")


def frequency_table(stored: DataFrame, symbols: int):
    """Frequencies over all documents: each task counts into one array, a row per symbol and task is added up."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(symbols, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                counts += np.bincount(np.frombuffer(ids.as_buffer(), "<u2"), minlength=symbols)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], ["id", "n"])

    rows = stored.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(symbols, np.int64)  # one number per vocabulary entry reaches the driver
    for row in rows:
        counts[row["id"]] = row["n"]
    return scaled_frequencies(counts)


def write(stored: DataFrame, freq, path: str) -> DataFrame:
    """Files of blocks in ascending document order, one per range of ids; returns the checkpoints."""
    spark = stored.sparkSession
    total = stored.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, -(-total // FILE_TOKENS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BLOCK_TOKENS))
    shared = spark.sparkContext.broadcast(freq)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        code = Table(shared.value)
        part, found = TaskContext.get().partitionId(), []
        system, plain = filesystem(path)
        name = f"{path}/part-{part:06d}-{uuid.uuid4().hex}.rans"
        out, at, first = None, 0, 0
        ids, lengths, held, size = [], [], [], 0

        def close_block() -> None:
            nonlocal out, at, first, size
            if out is None:
                system.create_dir(plain, recursive=True)
                out = system.open_output_stream(filesystem(name)[1])
            data = block_bytes(ids, lengths, np.concatenate(held), code)
            out.write(data)
            found.append((part, name, len(found), at, len(data), first, size, len(ids), zlib.crc32(data)))
            at, first, size = at + len(data), first + size, 0
            ids.clear(), lengths.clear(), held.clear()

        for batch in batches:
            for doc, data in zip(batch.column("doc_id"), batch.column("ids")):
                symbols = np.frombuffer(data.as_py(), "<u2").astype(np.int64)
                doc = doc.as_py()
                ids.append(NULL_ID if doc is None else doc)
                lengths.append(len(symbols))
                held.append(symbols)
                size += len(symbols)
                if size >= BLOCK_TOKENS:
                    close_block()
        if held:
            close_block()
        if out is not None:
            out.close()
            types = [pa.int32(), pa.string(), pa.int32(), *[pa.int64()] * 6]
            names = [c.split(" ")[0] for c in BLOCK_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

    ordered = stored.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    return materialize(ordered.mapInArrow(run, BLOCK_SCHEMA), "rans-checkpoints")


def read(checkpoints: DataFrame, freq) -> DataFrame:
    """Decode all blocks in parallel: document id, ids before it in its block's file, and its ids."""
    spark = checkpoints.sparkSession
    shared = spark.sparkContext.broadcast(freq)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        code = Table(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths, symbols = parse_block(read_bytes(row["path"], row["offset"], row["size"]), row["crc32"], code)
                ends = np.cumsum(lengths, dtype=np.int64)
                data = [symbols[e - n : e].astype("<u4").tobytes() for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), row["part"]), pa.int32()),
                        pa.array([None if i == NULL_ID else i for i in ids.tolist()], pa.int64()),
                        pa.array(row["first_token"] + ends - lengths, pa.int64()),
                        pa.array(lengths.astype(np.int64)),
                        pa.array(data, pa.binary()),
                    ],
                    ["part", "doc_id", "first_token", "n_tokens", "ids"],
                )

    schema = "part int, doc_id bigint, first_token bigint, n_tokens bigint, ids binary"
    tasks = max(checkpoints.count() // 16, spark.sparkContext.defaultParallelism * 4)
    return checkpoints.repartition(tasks).mapInArrow(run, schema)


def with_starts(decoded: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Ids of all documents before: those in earlier files (one row per file, checked) and in the same one."""
    files = checkpoints.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return decoded.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("first_token")).alias("start"), "n_tokens", "ids"
    )


def op4_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids, read the files back, and digest what was read."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    stored = materialize(tokens(table(spark, sf_dir, "documents"), path, END_ID), "rans-ids")
    freq = frequency_table(stored, Tokenizer.from_file(path).get_vocab_size())
    checkpoints = write(stored, freq, scratch_path(spark, "rans"))
    back = with_starts(read(checkpoints, freq), checkpoints)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op4_rans": op4_rans}
ORACLE: dict[str, str] = {}
