"""Benchmark decontamination with suffix arrays over the training text.

Documents are taken in shards (whole rows of a task, about ``SHARD_BYTES`` together). A shard's words become
numbers of the tests' vocabulary, 0 for any other word; runs too short for the shortest window of a test cannot hold
one and are left out; the rest goes into a suffix array. Every suffix of every test is binary-searched in it: the
suffixes that start with its first ``window`` words are its occurrences, each is extended to the longest verbatim
match, and words inside any match are hit. Words meet through a 64-bit hash and are then compared byte by byte.
No rows are shuffled. Tests are read in blocks of about ``BLOCK_BYTES``; more than one block means one pass each.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case. A test with fewer words than
``window``, but not none, is one window. Null and empty texts have no words and are never hit; null or blank tests
hit nothing. A test without id hits words but is not among the items. Rows that repeat an item id are one item; rows
that repeat a document id stay separate rows, each judged on its own text; a null id stays null. Empty tables
give no rows, or documents without hits. Further columns are left out by ``scan`` and kept by ``without_leaks``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.llm.common import slices, table
from tallyglass.workspace import materialize

WINDOW = 10
SHARD_BYTES = 4_000_000
BLOCK_BYTES = 16_000_000
PAIRS = 2_000_000  # matches held at a time
REPORT = (
    "n_words bigint, spans array<struct<start:bigint,length:bigint>>,"
    " matches array<struct<item_id:string,item_start:bigint,doc_start:bigint,length:bigint>>"
)
_SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64())])
_MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("length", pa.int64())])

_BYTES = np.arange(256)
IS_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
_PRIME = np.uint64(0x100000001B3)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased UTF-8 bytes of a text column and the offsets of its rows; nulls are empty."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return LOWER[raw], at - at[0]


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every word, and the number of the first word of each row (and of the end)."""
    inside = IS_WORD[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[at[at < len(data)]] = False
    after[at[at > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    return starts, lengths, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, longest: int, seed: int) -> np.ndarray:
    """A 64-bit hash of every word of at most ``longest`` bytes."""
    out = np.full(len(starts), seed, np.uint64)
    alive, k = np.flatnonzero(lengths <= longest), 0
    while len(alive):
        out[alive] = (out[alive] ^ data[starts[alive] + k]) * _PRIME
        k += 1
        alive = alive[lengths[alive] > k]
    return out


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes that begin with a word, ordered by their first ``depth`` words.

    A 0 ends a suffix; the last entry of ``text`` is 0. Suffixes that are equal that far come in any order.
    """
    at = np.flatnonzero(text)
    rank, reach = text.astype(np.int64), 1
    order = np.argsort(rank[at], kind="stable")
    while True:
        sorted_at = at[order]
        if reach >= depth:
            return sorted_at
        ahead = np.zeros(len(at), np.int64)
        inside = sorted_at + reach < len(text)
        ahead[inside] = rank[sorted_at[inside] + reach]
        key = rank[sorted_at] * (max(len(text), int(rank.max(initial=0))) + 1) + ahead
        again = np.argsort(key, kind="stable")
        key, order = key[again], order[again]
        fresh = np.cumsum(np.concatenate(([1], (key[1:] != key[:-1]).astype(np.int64)))) if len(key) else key
        rank = np.zeros(len(text), np.int64)
        rank[at[order]] = fresh
        reach *= 2
        if len(fresh) and fresh[-1] == len(fresh):
            return at[order]


class Tests:
    """A block of tests: their words as numbers of one vocabulary, and their suffixes."""

    __test__ = False

    def __init__(self, ids: list[str | None], texts: pa.Array, window: int = WINDOW):
        data, at = text_bytes(texts)
        starts, lengths, first = words(data, at)
        self.ids, self.window = ids, window
        self.longest = int(lengths.max(initial=0))
        raw = data.tobytes()
        spelled = [raw[s : s + n] for s, n in zip(starts.tolist(), lengths.tolist())]
        vocabulary = sorted(set(spelled))
        sample = np.frombuffer(b"".join(vocabulary), np.uint8)
        size = np.array([len(w) for w in vocabulary], np.int64)
        begin = np.cumsum(size) - size
        seed = 14695981039346656037
        while True:  # until no two words of the vocabulary share a hash
            hashed = word_hashes(sample, begin, size, self.longest, seed)
            if len(np.unique(hashed)) == len(hashed):
                break
            seed += 1
        order = np.argsort(hashed)
        self.seed, self.hashes = seed, hashed[order]
        self.sample, self.begin, self.size = sample, begin[order], size[order]
        number = {vocabulary[w]: i + 1 for i, w in enumerate(order.tolist())}
        # Tests one after another, a 0 before, between and behind them.
        parts, self.starts, self.items = [np.zeros(1, np.int64)], [], []
        q_start, q_length, q_window, q_item = [], [], [], []
        place = 1
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            n = b - a
            self.starts.append(place)
            if not n:
                continue
            parts += [np.array([number[w] for w in spelled[a:b]], np.int64), np.zeros(1, np.int64)]
            need = min(window, n)
            span = np.arange(n - need + 1)
            q_start.append(place + span)
            q_length.append(n - span)
            q_window.append(np.full(len(span), need))
            q_item.append(np.full(len(span), i))
            place += n + 1
        join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        self.text = join(parts)
        self.q_start, self.q_length, self.q_window, self.q_item = join(q_start), join(q_length), join(q_window), join(q_item)
        self.starts = np.array(self.starts, np.int64)
        self.shortest = int(self.q_window.min(initial=window))
        self.depth = int(self.q_length.max(initial=0))

    def numbers(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each word by its hash, 0 if no test has it. ``confirm`` compares the letters."""
        if not len(self.hashes):
            return np.zeros(len(starts), np.int64)
        hashed = word_hashes(data, starts, lengths, self.longest, self.seed)
        near = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
        return np.where((self.hashes[near] == hashed) & (lengths <= self.longest), near + 1, 0)

    def confirm(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Whether each word is spelled like the vocabulary's word of its number."""
        word = numbers - 1
        same = self.size[word] == lengths
        alive, k = np.flatnonzero(same), 0
        while len(alive):
            same[alive] = data[starts[alive] + k] == self.sample[self.begin[word[alive]] + k]
            k += 1
            alive = alive[same[alive] & (lengths[alive] > k)]
        return same

    def bound(self, text: np.ndarray, order: np.ndarray, upper: bool) -> np.ndarray:
        """For each test suffix, how many of the array's suffixes are below its window (or not above it)."""
        low, high = np.zeros(len(self.q_start), np.int64), np.full(len(self.q_start), len(order), np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            side = self._compare(text, order[middle], open_)
            right = side <= 0 if upper else side < 0
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]

    def _compare(self, text: np.ndarray, place: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        side = np.zeros(len(suffix), np.int64)
        alive, k = np.arange(len(suffix)), 0
        while len(alive):
            mine, theirs = text[place[alive] + k], self.text[self.q_start[suffix[alive]] + k]
            side[alive] = np.sign(mine - theirs)
            k += 1
            alive = alive[(mine == theirs) & (self.q_window[suffix[alive]] > k)]
        return side

    def matches(self, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Longest verbatim matches: place in ``text``, place in the tests' text, words; not extensible to either side."""
        order = suffix_array(text, self.depth)
        low, high = self.bound(text, order, False), self.bound(text, order, True)
        count = high - low
        done = np.cumsum(count)
        first = 0
        while first < len(count):
            last = max(first + 1, int(np.searchsorted(done, (done[first - 1] if first else 0) + PAIRS, "right")))
            some = np.arange(first, last)[count[first:last] > 0]
            first = last
            if not len(some):
                continue
            suffix = np.repeat(some, count[some])
            step = np.arange(len(suffix)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            place, test = order[low[suffix] + step], self.q_start[suffix]
            left = (place > 0) & (text[place - 1] == self.text[test - 1]) & (text[place - 1] > 0)
            place, test = place[~left], test[~left]
            length = np.zeros(len(place), np.int64)
            alive = np.arange(len(place))
            while len(alive):
                same = (text[place[alive] + length[alive]] == self.text[test[alive] + length[alive]]) & (self.text[test[alive] + length[alive]] > 0)
                alive = alive[same]
                length[alive] += 1
            yield place, test, length


def shard_report(tests: Tests, texts: pa.Array) -> tuple[np.ndarray, list[list], list[dict]]:
    """Per row of a shard: words, spans of hit words, and per test its longest match (item start, start, words)."""
    data, at = text_bytes(texts)
    starts, lengths, first = words(data, at)
    counts = np.diff(first)
    spans: list[list] = [[] for _ in range(len(texts))]
    found: list[dict] = [{} for _ in range(len(texts))]
    numbers = tests.numbers(data, starts, lengths)
    row_of = np.repeat(np.arange(len(texts)), counts)
    kept = _long_runs(numbers, row_of, tests.shortest)
    wrong = kept[~tests.confirm(data, starts[kept], lengths[kept], numbers[kept])]
    if len(wrong):
        numbers[wrong] = 0
        kept = _long_runs(numbers, row_of, tests.shortest)
    if not len(kept) or not len(tests.q_start):
        return counts, spans, found
    # The kept runs one after another; a 0 wherever the next kept word does not follow in the same row.
    gap = np.concatenate(([True], (np.diff(kept) != 1) | (np.diff(row_of[kept]) != 0)))
    place_of = np.arange(len(kept)) + np.cumsum(gap)
    text = np.zeros(place_of[-1] + 2, np.int64)
    text[place_of] = numbers[kept]
    word_of = np.full(len(text), -1, np.int64)
    word_of[place_of] = kept
    change = np.zeros(len(text) + 1, np.int64)
    for place, test, length in tests.matches(text):
        np.add.at(change, place, 1)
        np.add.at(change, place + length, -1)
        word, item = word_of[place], np.searchsorted(tests.starts, test, "right") - 1
        rows = row_of[word]
        order = np.lexsort((test, word, -length, item, rows))
        lead = order[np.concatenate(([True], (np.diff(rows[order]) != 0) | (np.diff(item[order]) != 0)))] if len(order) else order
        for r, i, t, w, n in zip(rows[lead].tolist(), item[lead].tolist(), test[lead].tolist(), word[lead].tolist(), length[lead].tolist()):
            _longer(found[r], tests.ids[i], (t - int(tests.starts[i]), w - int(first[r]), n))
    hit = word_of[np.flatnonzero(np.cumsum(change[:-1]) > 0)]
    if len(hit):
        cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(row_of[hit]) != 0)) + 1
        for piece_start, piece_end in zip(np.concatenate(([0], cut)).tolist(), np.concatenate((cut, [len(hit)])).tolist()):
            r = int(row_of[hit[piece_start]])
            spans[r].append((int(hit[piece_start] - first[r]), piece_end - piece_start))
    return counts, spans, found


def _long_runs(numbers: np.ndarray, row_of: np.ndarray, shortest: int) -> np.ndarray:
    """Words in runs of at least ``shortest`` vocabulary words of one row."""
    known = np.flatnonzero(numbers)
    if not len(known):
        return known
    new = np.concatenate(([True], (np.diff(known) != 1) | (np.diff(row_of[known]) != 0)))
    run = np.cumsum(new) - 1
    return known[np.bincount(run)[run] >= shortest]


def _longer(found: dict, item: str | None, match: tuple) -> None:
    """Keep an item's longest match; ties go to the earlier place in the document, then in the item."""
    old = found.get(item)
    if old is None or (-match[2], match[1], match[0]) < (-old[2], old[1], old[0]):
        found[item] = match


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, length in sorted(spans):
        if out and start <= out[-1][0] + out[-1][1]:
            out[-1][1] = max(out[-1][1], start + length - out[-1][0])
        else:
            out.append([start, length])
    return [tuple(s) for s in out]


def _blocks(tests: DataFrame) -> Iterator[Tests]:
    """The distinct tests in blocks, one at a time on the driver; at least one, maybe empty."""
    rows = tests.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null").distinct()
    stored = materialize(rows, "tests")
    size = stored.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    count = max(1, math.ceil(size / BLOCK_BYTES))
    for block in range(count):
        part = stored.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).sort("item_id", "text").toArrow()
        texts = part.column("text").combine_chunks().cast(pa.large_string())
        yield Tests(part.column("item_id").to_pylist(), texts)


def _reports(batches: Iterator[pa.RecordBatch], tests: Tests) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list, list]]:
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column("text")
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for a, b in slices(batch, sizes, SHARD_BYTES):
            part = batch.slice(a, b - a)
            yield part, *shard_report(tests, part.column("text").cast(pa.large_string()))


def scan(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``spans`` of hit words, longest match of each found test."""
    state = docs.select("doc_id", "text")
    blocks = _blocks(tests)
    block, begun = next(blocks), False
    while block is not None:
        following = next(blocks, None)
        state = _pass(state, block, begun, last=following is None)
        if following is not None:
            state = materialize(state, "leaks")
        block, begun = following, True
    return state


def _pass(state: DataFrame, block: Tests, begun: bool, last: bool) -> DataFrame:
    columns = ["doc_id"] if last else ["doc_id", "text"]
    schema = T.StructType([state.schema[c] for c in columns] + T.StructType.fromDDL(REPORT).fields)

    def run(batches):
        for part, counts, spans, found in _reports(batches, block):
            if begun:
                for i, (old_spans, old_matches) in enumerate(zip(part.column("spans").to_pylist(), part.column("matches").to_pylist())):
                    spans[i] = _joined(spans[i] + [(s["start"], s["length"]) for s in old_spans])
                    for m in old_matches:
                        _longer(found[i], m["item_id"], (m["item_start"], m["doc_start"], m["length"]))
            held = [
                [{"item_id": k, "item_start": m[0], "doc_start": m[1], "length": m[2]} for k, m in sorted(f.items(), key=lambda x: (x[0] is not None, x[0]))]
                for f in found
            ]
            listed = [[{"start": s, "length": n} for s, n in row] for row in spans]
            arrays = [part.column(c) for c in columns]
            arrays += [pa.array(counts, pa.int64()), pa.array(listed, pa.list_(_SPAN)), pa.array(held, pa.list_(_MATCH))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "n_words", "spans", "matches"])

    return state.mapInArrow(run, schema)


def without_leaks(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """The documents, all columns, of which no word lies in a window of a test."""
    for block in _blocks(tests):

        def run(batches, block=block):
            for part, _, spans, _ in _reports(batches, block):
                yield part.filter(pa.array([not s for s in spans]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def digest(report: DataFrame) -> DataFrame:
    """Counts and the digest of the found items, in built-in functions."""
    items = F.sort_array(F.array_distinct(F.filter(F.transform("matches", lambda m: m["item_id"]), lambda i: i.isNotNull())))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["length"])
    return report.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


QUERIES = {"op12_decontaminate": op12_decontaminate}
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
ORACLE = {
    "op12_decontaminate": f"""
with d as (
  select row_number() over () as row_id, doc_id, {_WORDS} as w from documents
), i as (
  select item_id, {_WORDS} as w from benchmark
), windows as (
  select distinct item_id, least({WINDOW}, len(w)) as size,
    array_to_string(w[p : p + least({WINDOW}, len(w)) - 1], ' ') as words
  from (select item_id, w, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) as p from i where len(w) > 0)
), places as (
  select row_id, w, size, unnest(range(1, len(w) - size + 2)) as p
  from d, (select distinct size from windows) where len(w) >= size
), found as (
  select row_id, p, x.size, item_id from (select *, array_to_string(w[p : p + size - 1], ' ') as words from places) x
  join windows v on v.size = x.size and v.words = x.words
), hit as (
  select row_id, count(distinct place) as n from (select row_id, unnest(range(p, p + size)) as place from found) group by 1
), items as (
  select row_id, count(*) as n, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as listed
  from (select distinct row_id, item_id from found where item_id is not null) group by 1
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(hit.n, 0) as n_hit, coalesce(items.n, 0) as n_items,
  sha256(coalesce(listed, '')) as items_sha256, coalesce(hit.n, 0) > 0 as contaminated
from d left join hit using (row_id) left join items using (row_id)
""",
}
