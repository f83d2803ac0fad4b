"""N-gram Jaccard join with signature trees.

Documents are sets of 5-word shingles; two link when 100 * intersection >= 75 * union. Documents with equal
sets are one class, named by its least id. Classes that can link share a shingle among the rarest quarter of
each set; a fixed array of counters, added up over all documents, orders shingles by rarity. With prefixes
longer by a tenth of the set, two sets that link share about a tenth of their size within their prefixes: a
class that shares fewer with all others together is dropped, and again, as what is left shares less. Two classes
that link share so much of what is left of their prefixes that they also share a shingle among the first of it in order
of exact frequency; a frequent passage stands last there and connects nothing. Classes that share one of those shingles,
directly or through others, form a pool; every link lies within one. Members of
pools that are too large for one task are pooled again with the exact frequency of every shingle among them;
a class of which less than 75 % of the shingles occur in another class links with nothing and drops out.

Within a pool a signature tree does the join. A leaf is a class: its size and a bitmap of its shingles' hashes.
An inner node holds the OR of its children's bitmaps and the range of their sizes. Two nodes are walked
together, from the roots down; a pair of nodes is dropped when its size ranges are too far apart or when its
bitmaps show that no leaf below can share enough with any leaf on the other side. Leaves that survive are
compared exactly, unless they are linked through others already.

A pool of up to ``POOL_ROWS`` classes is one task. In one that is still larger every class is first compared
with the pool's first class, which links a group of near copies in one pass; the others are then held, in
blocks, against the whole pool, cut by a digest.

A null or empty text has an empty set and is linked with nothing. Rows are judged by their text, so rows that
repeat an id with different texts can lie in different components; null ids get null. An empty table gives no rows.
Further columns stay in ``first_of_components``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.llm.common import bounded_batches, slices, table
from tallyglass.llm.components import star_components
from tallyglass.workspace import checked_broadcast, materialize

SHINGLE = 5
COUNTER_BITS = 22
COUNTER_CHUNK = 1 << 16
EXTRA = 0.1
PRUNING_ROUNDS = 2
POOL_ROWS = 512
FANOUT = 8
SIGNATURE_BITS = 4096
MAX_BROADCAST_KEYS = 400_000
SLICE = 1_000_000
SEEN_CLASSES = 200_000
SLOTS = np.uint64((1 << COUNTER_BITS) - 1)

_rng = np.random.default_rng(20240501)
BYTE_CODES = _rng.integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
NEXT_BLANK = re.compile(rb"[\x20\x09-\x0D]")
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x):
    """A finishing mix of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int):
    out = np.full(n, WORD_BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: bytes):
    """64-bit hash of every word of UTF-8 data (A-Z lowered, split at ASCII white space), and where each starts.

    A word's hash is a polynomial in its bytes' random codes, from running sums over the whole data; the
    inverse powers bring each word to its own origin.
    """
    raw = np.frombuffer(data, np.uint8)
    blank = BLANK[raw]
    inside = ~blank
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    codes = np.where(blank, np.uint64(0), BYTE_CODES[LOWER[raw]])
    lengths = ends - starts
    place = np.arange(len(raw)) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(raw)]))))
    powers = _powers(int(lengths.max()) + 1)
    place[blank] = 0
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * powers[place], dtype=np.uint64)))
    return mixed(sums[ends] - sums[starts] + lengths.astype(np.uint64)), starts


def _words(blobs: list[bytes]):
    """Word hashes of texts, and the end of each text among them. A long text is hashed in pieces cut at blanks."""
    if len(blobs) == 1 and len(blobs[0]) > 2 * SLICE:
        blob, at, parts = blobs[0], 0, []
        while at < len(blob):
            cut = NEXT_BLANK.search(blob, at + SLICE)
            end = cut.start() if cut else len(blob)
            parts.append(word_hashes(blob[at:end])[0])
            at = end
        words = np.concatenate(parts)
        return words, np.array([len(words)])
    words, starts = word_hashes(b"\n".join(blobs))
    return words, np.searchsorted(starts, np.cumsum([len(b) + 1 for b in blobs]))


def shingle_sets(texts: list[str | None]) -> list:
    """Ascending distinct shingle hashes of each text, about a million bytes at a time."""
    blobs, out = [(t or "").encode("utf-8", "replace") for t in texts], []
    for a, b in slices(None, [len(x) for x in blobs], SLICE):
        out += _shingle_sets(blobs[a:b])
    return out


def _shingle_sets(blobs: list[bytes]) -> list:
    words, last = _words(blobs)
    first = np.concatenate(([0], last[:-1]))
    runs = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        runs = (runs + words[k : k + len(runs)]) * WORD_BASE
    runs = mixed(runs)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a : b - SHINGLE + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for i in range(a, b):
                short = mixed((short + words[i : i + 1]) * WORD_BASE + np.uint64(1))
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(shingles) -> int:
    """A 64-bit digest of a set."""
    if not len(shingles):
        return 0
    a = np.bitwise_xor.reduce(mixed(shingles + np.uint64(1)))
    b = np.sum(mixed(shingles ^ WORD_BASE), dtype=np.uint64)
    return int(mixed(np.array([a, b + np.uint64(len(shingles))])).sum(dtype=np.uint64).astype(np.int64))


def prefix_size(n: int) -> int:
    """Two sets that link share k in prefixes of n - ceil(0.75 n) + k; here k is a tenth of n, and one."""
    return n - (3 * n + 3) // 4 + int(EXTRA * n) + 1


def least_shared(n: int) -> int:
    """What a set of n shares at least, within the prefixes, with any set it links to (of 0.75 n at least)."""
    return int(EXTRA * ((3 * n + 3) // 4)) + 1


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string"))


def text_slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list]]:
    """Row ranges of a batch with their texts, about a million bytes at a time."""
    texts = batch.column("text")
    for a, b in slices(batch, pc.fill_null(pc.binary_length(texts), 0).to_pylist(), SLICE):
        yield a, b, texts.slice(a, b - a).to_pylist()


def scan(docs: DataFrame) -> DataFrame:
    """A row per document (size and digest of its set), and per task the counters of all shingles in chunks."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << COUNTER_BITS, np.uint32)
        names = ["doc_id", "text_key", "n_shingles", "c", "chunk", "counts"]
        for batch in batches:
            for a, b, texts in text_slices(batch):
                sets = shingle_sets(texts)
                slot, n = np.unique(np.concatenate(sets) & SLOTS, return_counts=True)
                counters[slot.astype(np.int64)] += n.astype(np.uint32)
                none = pa.nulls(b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(x).slice(a, b - a) for x in names[:2]],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest(s) for s in sets], pa.int64()),
                        none.cast(pa.int32()),
                        none.cast(pa.binary()),
                    ],
                    names,
                )
        for i, chunk in enumerate(counters.reshape(-1, COUNTER_CHUNK)):
            if chunk.any():
                data = zlib.compress(chunk.astype("<u4").tobytes(), 1)
                none = pa.nulls(1).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([none] * 4 + [pa.array([i], pa.int32()), pa.array([data], pa.binary())], names)

    return keyed(docs).mapInArrow(run, "doc_id bigint, text_key bigint, n_shingles bigint, c bigint, chunk int, counts binary")


def rarity_levels(scanned: DataFrame) -> bytes:
    """One byte for each of 2^22 counters, compressed: the doublings of its count over twice the mean."""
    mean = (scanned.agg(F.sum("n_shingles")).first()[0] or 0) / (1 << COUNTER_BITS)

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(COUNTER_CHUNK, np.int64)
        for data in batch["counts"]:
            total += np.frombuffer(zlib.decompress(data), "<u4")
        over = np.ceil(np.log2(np.maximum(1.0, total / max(1.0, 2 * mean)))).astype(np.uint8)
        return pd.DataFrame({"chunk": [batch["chunk"].iloc[0]], "levels": [zlib.compress(over.tobytes(), 1)]})

    rows = scanned.filter("chunk is not null").select("chunk", "counts")
    levels = np.zeros(1 << COUNTER_BITS, np.uint8).reshape(-1, COUNTER_CHUNK)
    for row in rows.groupBy("chunk").applyInPandas(add, "chunk int, levels binary").collect():
        levels[row["chunk"]] = np.frombuffer(zlib.decompress(row["levels"]), np.uint8)
    return zlib.compress(levels.tobytes(), 1)


def postings(docs: DataFrame, levels: bytes) -> DataFrame:
    """(token, class, frequent, least) for the rarest shingles of every document; see ``least_shared``."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        seen: set[int] = set()
        for batch in batches:
            for a, b, texts in text_slices(batch):
                tokens, classes, least = [], [], []
                for s in shingle_sets(texts):
                    c = digest(s)
                    if not len(s) or c in seen:
                        continue
                    if len(seen) < SEEN_CLASSES:
                        seen.add(c)
                    # s ascends, so a stable sort by level orders equal levels by hash
                    order = np.argsort(level[(s & SLOTS).astype(np.int64)], kind="stable")
                    some = s[order[: prefix_size(len(s))]]
                    tokens.append(some)
                    classes.append(np.full(len(some), c, np.int64))
                    least.append(np.full(len(some), least_shared(len(s)), np.int32))
                if tokens:
                    token = np.concatenate(tokens)
                    frequent = level[(token & SLOTS).astype(np.int64)] > 0
                    columns = [token.view(np.int64), np.concatenate(classes), frequent, np.concatenate(least)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["token", "c", "frequent", "least"])

    return keyed(docs).select("text").mapInArrow(run, "token bigint, c bigint, frequent boolean, least int")


def pools(posted: DataFrame) -> DataFrame:
    """Pool (``root``) of every class ``c`` that may link with another.

    The postings move once: rare tokens by token, and the counters bound how many rows such a token has; rows
    of frequent tokens by class, as they stay in any case. What is shared is small, and is pruned by aggregates
    and joins.
    """
    dealt = posted.withColumn("key", F.when(F.col("frequent"), F.xxhash64("c")).otherwise(F.col("token")))
    held = Window.partitionBy("key")
    rows = dealt.withColumns({"low": F.min("c").over(held), "top": F.max("c").over(held)})
    rows = materialize(rows.filter("frequent or low <> top").select("token", "c", "least").distinct(), "ngram-postings")
    for _ in range(PRUNING_ROUNDS):
        several = rows.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("top")).filter("low <> top").select("token")
        rows = rows.join(several, "token")
        able = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.first("least").alias("m")).filter("n >= m").select("c")
        rows = materialize(rows.join(able, "c"), "ngram-postings")
    return star_components(hub_edges(rarest_shared(rows)), "ngram-pools").withColumnRenamed("vertex", "c")


def rarest_shared(rows: DataFrame) -> DataFrame:
    """(token, c): of the k tokens that a class shares, of which it needs m, the k - m + 1 that fewest classes have.

    Two linked classes have at least the larger m in common; the first of these in the order lies that early in both.
    """
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("classes"))
    held = rows.join(counts, "token").groupBy("c").agg(
        F.sort_array(F.collect_list(F.struct("classes", "token"))).alias("held"), F.first("least").alias("m")
    )
    first = F.slice("held.token", F.lit(1), F.greatest(F.lit(0), F.size("held") - F.col("m") + 1))
    return held.select("c", F.explode(first).alias("token"))


def hub_edges(rows: DataFrame) -> DataFrame:
    """Edges from the classes of each token to its least class."""
    rows = materialize(rows.select("token", "c"), "ngram-prefix")
    hubs = rows.groupBy("token").agg(F.min("c").alias("hub"))
    return rows.join(hubs, "token").select(F.col("c").alias("a"), F.col("hub").alias("b")).filter("a <> b")


def pools_again(texts: DataFrame) -> DataFrame:
    """Pools of the given classes by exact frequencies among them; classes that cannot link are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = batch.column("c").to_numpy(zero_copy_only=False)
            for a, b, part in text_slices(batch):
                sets = shingle_sets(part)
                sizes = np.array([len(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(sets).view(np.int64)),
                        pa.array(np.repeat(classes[a:b], sizes)),
                        pa.array(np.repeat(sizes, sizes).astype(np.int32)),
                    ],
                    ["token", "c", "n"],
                )

    rows = texts.select("c", "text").mapInArrow(run, "token bigint, c bigint, n int")
    counted = rows.withColumn("classes", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("classes > 1")
    counted = materialize(counted, "ngram-shared")
    able = counted.groupBy("c").agg(F.count(F.lit(1)).alias("common"), F.first("n").alias("size")).filter("100 * common >= 75 * size")
    order = Window.partitionBy("c").orderBy("classes", "token")
    ranked = counted.join(able, "c").withColumn("place", F.row_number().over(order) + F.col("size") - F.col("common"))
    prefix = ranked.filter(F.col("place") <= F.col("size") - F.floor((3 * F.col("size") + 3) / 4) + 1)
    return star_components(hub_edges(prefix), "ngram-pools").withColumnRenamed("vertex", "c")


class Node:
    """Bitmap (OR of all leaves below), sizes, and how many shingles share a bit with another in a leaf at most."""

    __slots__ = ("bits", "low", "high", "hidden", "children", "leaf")

    def __init__(self, bits, low, high, hidden, children=None, leaf=-1):
        self.bits, self.low, self.high, self.hidden, self.children, self.leaf = bits, low, high, hidden, children, leaf


def signature(shingles):
    bits = np.zeros(SIGNATURE_BITS // 64, np.uint64)
    place = shingles & np.uint64(SIGNATURE_BITS - 1)
    np.bitwise_or.at(bits, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return bits


def tree(sets: list, numbers: list[int]) -> Node:
    """Leaves in order of size and least shingle, so that near copies are neighbours, ``FANOUT`` to a node."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]).bit_length(), sets[i][0] if len(sets[i]) else 0, len(sets[i])))
    level = []
    for i in order:
        bits, n = signature(sets[i]), len(sets[i])
        level.append(Node(bits, n, n, n - int(np.bitwise_count(bits).sum()), leaf=numbers[i]))
    while len(level) > 1:
        level = [
            Node(
                np.bitwise_or.reduce([c.bits for c in group]),
                min(c.low for c in group),
                max(c.high for c in group),
                max(c.hidden for c in group),
                group,
            )
            for group in (level[i : i + FANOUT] for i in range(0, len(level), FANOUT))
        ]
    return level[0]


def may_link(a: Node, b: Node) -> bool:
    """Whether a leaf below ``a`` and one below ``b`` can link.

    The size ranges must allow 75 %. The overlap of two leaves is at most the bits that both nodes have plus
    the shingles that hide behind another's bit in either leaf, and 75 % of the larger set at least.
    """
    if 100 * min(a.high, b.high) < 75 * max(a.low, b.low):
        return False
    most = int(np.bitwise_count(a.bits & b.bits).sum()) + min(a.hidden, b.hidden)
    return 100 * most >= 75 * max(a.low, b.low)


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def linked(x, y) -> bool:
    n = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * n >= 75 * (len(x) + len(y) - n) and n > 0


def dual_join(left: Node, right: Node, sets: list, union: Union) -> list[tuple[int, int]]:
    """Links that connect what was not connected, found by walking both trees."""
    out, stack = [], [(left, right)]
    while stack:
        a, b = stack.pop()
        if a.leaf >= 0 and b.leaf >= 0:
            if a.leaf != b.leaf and union.root(a.leaf) != union.root(b.leaf) and may_link(a, b) and linked(sets[a.leaf], sets[b.leaf]):
                union.join(a.leaf, b.leaf)
                out.append((a.leaf, b.leaf))
            continue
        if not may_link(a, b):
            continue
        if a is b:
            stack += [(x, y) for i, x in enumerate(a.children) for y in a.children[i:]]
        elif b.leaf >= 0 or (a.leaf < 0 and len(a.children) and a.high - a.low >= b.high - b.low):
            stack += [(x, b) for x in a.children]
        else:
            stack += [(a, y) for y in b.children]
    return out


LINK = "a bigint, b bigint"


def _links(found, classes) -> pd.DataFrame:
    pairs = [(classes[i], classes[j]) for i, j in found]
    return pd.DataFrame({"a": [x for x, _ in pairs], "b": [y for _, y in pairs]}).astype("int64")


def pool_links(pool: pd.DataFrame) -> pd.DataFrame:
    """Spanning links of a small pool."""
    if len(pool) < 2:
        return _links([], [])
    sets = shingle_sets(list(pool["text"]))
    root = tree(sets, list(range(len(sets))))
    return _links(dual_join(root, root, sets, Union(len(sets))), pool["c"].tolist())


def block_links(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """Links between a block of a large pool's classes and a part of the pool."""
    if not len(asked) or not len(held):
        return _links([], [])
    sets = shingle_sets(list(asked["text"]) + list(held["text"]))
    classes = asked["c"].tolist() + held["c"].tolist()
    union, seen = Union(len(sets)), {}
    for i, c in enumerate(classes):
        union.join(seen.setdefault(c, i), i)
    n = len(asked)
    left, right = tree(sets[:n], list(range(n))), tree(sets[n:], list(range(n, len(sets))))
    return _links(dual_join(left, right, sets, union), classes)


def links(docs: DataFrame, scanned: DataFrame, levels: bytes) -> DataFrame:
    """Spanning links between classes: every two linked classes are connected by them."""
    found = pools(postings(docs, levels))
    classes = scanned.filter("n_shingles > 0").groupBy("c").agg(F.min("text_key").alias("text_key"))
    # A class is read from one of its texts; equal sets need not be equal texts.
    members = materialize(found.join(classes, "c").select("c", "root", "text_key"), "ngram-members")
    wanted = checked_broadcast(members, "ngram-wanted", MAX_BROADCAST_KEYS, stored=True)
    texts = keyed(docs).select("text_key", "text").join(wanted, "text_key").dropDuplicates(["c"])
    texts = materialize(texts.select("c", "root", "text"), "ngram-texts")
    sizes = checked_broadcast(texts.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "ngram-sizes", MAX_BROADCAST_KEYS)
    sized = texts.join(sizes, "root")
    out = sized.filter(F.col("size") <= POOL_ROWS).select("root", "c", "text").groupBy("root").applyInPandas(pool_links, LINK)
    large = sized.filter(F.col("size") > POOL_ROWS)
    if large.isEmpty():
        return out

    again = materialize(pools_again(large), "ngram-again")
    sizes = checked_broadcast(again.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "ngram-sizes", MAX_BROADCAST_KEYS)
    large = materialize(large.select("c", "text").join(again, "c").join(sizes, "root"), "ngram-large")
    small = large.filter(F.col("size") <= POOL_ROWS).select("root", "c", "text")
    out = out.unionByName(small.groupBy("root").applyInPandas(pool_links, LINK))
    large = large.filter(F.col("size") > POOL_ROWS)
    if large.isEmpty():
        return out
    heads = large.filter("c = root").select("root", F.col("text").alias("head"))

    def to_head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, object] = {}
        for df in batches:
            for a in range(0, len(df), 256):
                part = df.iloc[a : a + 256]
                for root, text in zip(part["root"], part["head"]):
                    if root not in kept:
                        if len(kept) > 64:
                            kept.clear()
                        kept[root] = shingle_sets([text])[0]
                near = [linked(s, kept[r]) for s, r in zip(shingle_sets(list(part["text"])), part["root"])]
                yield part.assign(near=near)[["root", "c", "near"]]

    judged = large.select("root", "c", "text").join(heads, "root")
    judged = materialize(judged.mapInPandas(to_head, "root bigint, c bigint, near boolean"), "ngram-heads")
    star = judged.filter("near and c <> root").select(F.col("c").alias("a"), F.col("root").alias("b"))
    rest = judged.filter(~F.col("near"))
    blocks = rest.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / POOL_ROWS).cast("int").alias("blocks"))
    spread = lambda n: F.pmod(F.xxhash64("c"), n).cast("int")
    parts = F.ceil(F.col("size") / POOL_ROWS).cast("int")
    rows = large.join(blocks, "root").withColumns({"parts": parts})
    asked = rows.join(rest.select("root", "c"), ["root", "c"]).withColumn("block", spread(F.col("blocks")))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    held = rows.withColumn("part", spread(F.col("parts"))).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["root", "block", "part"]
    asked = materialize(asked.select(*keys, "c", "text"), "ngram-asked")
    met = asked.groupBy(*keys).cogroup(held.select(*keys, "c", "text").groupBy(*keys)).applyInPandas(block_links, LINK)
    return out.unionByName(star).unionByName(met)


def labelled(docs: DataFrame) -> DataFrame:
    """Per document row: ``doc_id``, ``text_key``, ``n_shingles`` and the ``label`` of its component, null for empty sets."""
    scanned = materialize(scan(docs), "ngram-scan")
    rows = scanned.filter("chunk is null").drop("chunk", "counts")
    found = star_components(links(docs, rows, rarity_levels(scanned)), "ngram-components").withColumnRenamed("vertex", "c")
    named = rows.join(checked_broadcast(found, "ngram-labels", MAX_BROADCAST_KEYS), "c", "left")
    group = F.when(F.col("n_shingles") > 0, F.coalesce("root", "c"))
    return named.select("doc_id", "text_key", "n_shingles", group.alias("label"))


def components(docs: DataFrame) -> DataFrame:
    """Per document row: ``doc_id``, ``text_key``, ``n_shingles`` and ``component_id``."""
    rows = labelled(docs)
    least = rows.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "label", "left")
    return out.select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))


def first_of_components(docs: DataFrame) -> DataFrame:
    """One row of each component: the one with the least id, nulls last, then by digests of text and further columns.

    Empty sets all stay.
    """
    keys = ["doc_id", "text_key"]
    cells = labelled(docs).filter("label is not null").groupBy("label", *keys).agg(F.count(F.lit(1)).alias("n"))
    cells = materialize(cells, "ngram-cells")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    judged = cells.join(cells.groupBy("label").agg(first), "label")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    renamed = {"doc_id": "__near_doc", "text_key": "__near_text"}
    gone = checked_broadcast(judged.filter(~stays).select(*keys).withColumnsRenamed(renamed), "ngram-gone", MAX_BROADCAST_KEYS)
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__near_doc")) & (F.xxhash64("text") == F.col("__near_text"))
    kept = docs.join(gone, same, "left_anti")
    many = materialize(judged.filter(stays & (F.col("n") > 1)).select(*keys).withColumnsRenamed(renamed), "ngram-many")
    if many.isEmpty():
        return kept
    many = checked_broadcast(many, "ngram-many", MAX_BROADCAST_KEYS, stored=True)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    repeated = docs.join(many, same).groupBy("__near_doc", "__near_text")
    picked = repeated.agg(F.min_by(F.struct(*docs.columns), order).alias("__near_row")).select("__near_row.*")
    return kept.join(many, same, "left_anti").unionByName(picked)


def op10_ngramjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


QUERIES = {"op10_ngramjoin": op10_ngramjoin}
ORACLE = {
    "op10_ngramjoin": """
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') as w from documents
),
tokens as (
  select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end as token
  from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as i from words where len(w) > 0)
),
sizes as (select doc_id, count(*) as n from tokens group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as n from tokens a join tokens b on a.token = b.token and a.doc_id <> b.doc_id group by all
),
links as (
  select x, y from common o join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * o.n >= 75 * (a.n + b.n - o.n)
),
reach(doc_id, other) as (
  select doc_id, doc_id from documents union select doc_id, y from reach join links on other = x
)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id
from documents d left join sizes using (doc_id)
  join (select doc_id, min(other) as component_id from reach group by doc_id) using (doc_id)
"""
}
