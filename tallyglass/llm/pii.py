"""Personal data: base patterns, and identifiers that bootstrapped contexts add.

Every text is scanned, and once or twice more where patterns are accepted. Base matches are the seeds; other tokens with the
shape of an identifier (5 to 64 characters, three digits) are candidates. The two words before a mention, within 80 characters, are its pattern. On the graph of patterns and instances Spark
iterates: an instance is as sure as its surest pattern (a seed is sure), a pattern is as sure as the mean of
the instances it occurs with. What follows an accepted pattern is a seed for the next step, in all its other contexts,
until a step accepts no new pattern. Candidates that follow an accepted pattern are reported as ``context`` spans.
The second scan collects whatever else follows an accepted pattern: the next token of any shape and length, and
with it the tokens that continue a number. Each of these counts against its pattern; where the seeds and candidates
still make the pattern sure enough, a third scan reports them too (unless they hold no letter or digit).
Rounds work on pattern-instance pairs that are added up before they move; patterns below the support are
dropped first.

Null texts count as empty and have no spans. Rows that repeat an id and text get the same spans. An empty
table gives no rows. Further columns are left out.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.llm.common import slices, table
from tallyglass.workspace import materialize

KINDS = ("email", "ip", "card", "phone", "context")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The look-behind leaves the matches as they are and keeps long runs of digits linear.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
BARE = re.compile(r"[^0-9]")
EDGE = " \t\r\n\"'()[]{}<>,;:.!?"
WORD = re.compile(r"\S+")
# Starts inside a token: what follows one of the edge characters.
INNER = re.compile(r"(?<=[\"'()\[\]{}<>,;:.!?])[^\s\"'()\[\]{}<>,;:.!?]")
NUMBER = re.compile(r"\+?\(?[0-9][0-9()./-]*(?:[\x20\t]+\(?[0-9][0-9()./-]*)+(?=[\s,;:!?\"'\]}>]|$)")
SHAPE_CHARS = (5, 64)
SHAPE_DIGITS = 3
CONTEXT_CHARS = 80
CONTEXT_WORDS = 2
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.8
ROUNDS = 3
TASK_PATTERNS = 500_000
SLOT_BITS = 26
SLOT_CHUNK = 1 << 16

MENTION = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("pattern", pa.string()), ("instance", pa.string())])
)
FOLLOWER = [("start", pa.int64()), ("end", pa.int64()), ("pattern", pa.string()), ("fresh", pa.bool_()), ("named", pa.bool_())]
SCHEMA = "doc_id bigint, text_key bigint, mentions array<struct<start: bigint, end: bigint, kind: int, pattern: string, instance: string>>"


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at + 1)):
            done = found.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the four base kinds, leftmost and non-overlapping per kind, in order."""
    out = [(a, b, 0) for a, b in emails(text)]
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                out.append((*m.span(), 1))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = BARE.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((*m.span(), 2))
        for m in PHONE.finditer(text):
            if 10 <= len(BARE.sub("", m.group())) <= 15:
                out.append((*m.span(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Tokens with the length and the digits of an identifier that touch no base span."""
    out, done, nearest = [], 0, 0
    order = sorted(taken)
    for m in DIGITS.finditer(text):
        if m.start() < done:
            continue
        start, end = m.span()
        low, high = max(done, start - SHAPE_CHARS[1]), min(len(text), end + SHAPE_CHARS[1])
        while start > low and not text[start - 1].isspace():
            start -= 1
        while end < high and not text[end].isspace():
            end += 1
        done = end
        while start < end and text[start] in EDGE:
            start += 1
        while end > start and text[end - 1] in EDGE:
            end -= 1
        token = text[start:end]
        if not SHAPE_CHARS[0] <= len(token) <= SHAPE_CHARS[1] or sum(c.isdigit() for c in token) < SHAPE_DIGITS:
            continue
        while nearest < len(order) and order[nearest][1] <= start:
            nearest += 1
        if not any(a < end and start < b for a, b, _ in order[max(0, nearest - 4) : nearest + 4]):
            out.append((start, end))
    return out


def pattern(text: str, start: int) -> str | None:
    """The two words before, in lower case, digits as 0; none where there are fewer."""
    words = text[max(0, start - CONTEXT_CHARS) : start].lower().split()[-CONTEXT_WORDS:]
    return DIGITS.sub("0", " ".join(words)) if len(words) == CONTEXT_WORDS else None


def mentions(text: str) -> list[dict]:
    base = base_spans(text)
    found = [(a, b, k) for a, b, k in base] + [(a, b, None) for a, b in candidates(text, base)]
    return [{"start": a, "end": b, "kind": k, "pattern": pattern(text, a), "instance": text[a:b].lower()} for a, b, k in found]


def merged(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b, _ in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def slot(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) & ((1 << SLOT_BITS) - 1)


def followers(text: str, bits: bytes) -> list[dict]:
    """What follows the patterns whose slots are set and touches no base span, but for the candidates themselves.

    ``fresh`` says that no candidate starts there, ``named`` that there is a letter or a digit.
    """
    low = DIGITS.sub("0", text.lower()).split()
    spans = [m.span() for m in WORD.finditer(text)]
    hits = []
    for i in range(CONTEXT_WORDS, len(spans)):
        start = spans[i][0]
        if text[start] in EDGE:
            continue
        far = spans[i - CONTEXT_WORDS][0] < start - CONTEXT_CHARS
        before = pattern(text, start) if far else " ".join(low[i - CONTEXT_WORDS : i])
        if before is not None and bits[(h := slot(before)) >> 3] >> (h & 7) & 1:
            hits.append((start, before))
    for m in INNER.finditer(text):
        before = pattern(text, m.start())
        if before is not None and bits[(h := slot(before)) >> 3] >> (h & 7) & 1:
            hits.append((m.start(), before))
    if not hits:
        return []
    base = base_spans(text)
    shaped = dict(candidates(text, base))
    starts, ends = merged(base)
    out, done = [], 0
    for start, before in sorted(hits):
        if start < done:
            continue
        found = NUMBER.match(text, start) or WORD.match(text, start)
        end = found.end()
        while end > start and text[end - 1] in EDGE:
            end -= 1
        near = bisect_right(ends, start)
        if near < len(starts) and starts[near] < end or shaped.get(start) == end:
            continue
        done = end
        named = any(c.isalnum() for c in text[start:end])
        out.append({"start": start, "end": end, "pattern": before, "fresh": start not in shaped, "named": named})
    return out


def scan(docs: DataFrame) -> DataFrame:
    """Base matches and candidates of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(batch, [len(t.as_py() or "") for t in texts]):
                found = [mentions(t.as_py() or "") for t in texts.slice(a, b - a)]
                rows = [batch.column(c).slice(a, b - a) for c in ("doc_id", "text_key")]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(found, MENTION)], ["doc_id", "text_key", "mentions"])

    return keyed(docs).mapInArrow(run, SCHEMA)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.xxhash64("text").alias("text_key"))


def slots(patterns: DataFrame) -> bytes:
    """A bitmap of the patterns' CRC-32, compressed: 8 MB at most, whatever their number. It lets others pass too."""

    def fill(batch: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        bits = np.zeros(SLOT_CHUNK, np.uint8)
        bits[batch["slot"].to_numpy() % SLOT_CHUNK] = 1
        data = np.packbits(bits, bitorder="little").tobytes()
        return pd.DataFrame({"chunk": [batch["chunk"].iloc[0]], "bits": [data]})

    rows = patterns.select(F.crc32("pattern").bitwiseAND((1 << SLOT_BITS) - 1).alias("slot")).distinct()
    rows = rows.withColumn("chunk", F.floor(F.col("slot") / SLOT_CHUNK))
    out = bytearray(1 << SLOT_BITS - 3)
    for row in rows.groupBy("chunk").applyInPandas(fill, "chunk bigint, bits binary").collect():
        at = row["chunk"] * SLOT_CHUNK // 8
        out[at : at + SLOT_CHUNK // 8] = row["bits"]
    return zlib.compress(bytes(out), 1)


def scan_followers(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """What else follows the patterns, a row each (see ``followers``)."""
    shared = docs.sparkSession.sparkContext.broadcast(slots(patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = zlib.decompress(shared.value)
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(batch, [len(t.as_py() or "") for t in texts]):
                found = [(i, m) for i in range(a, b) for m in followers(texts[i].as_py() or "", bits)]
                rows = [batch.column(c).take(pa.array([i for i, _ in found], pa.int64())) for c in ("doc_id", "text_key")]
                added = [pa.array([m[n] for _, m in found], t) for n, t in FOLLOWER]
                yield pa.RecordBatch.from_arrays([*rows, *added], ["doc_id", "text_key", *[n for n, _ in FOLLOWER]])

    schema = "doc_id bigint, text_key bigint, start bigint, end bigint, pattern string, fresh boolean, named boolean"
    return keyed(docs).mapInArrow(run, schema).join(patterns.select("pattern"), "pattern")


def count_followers(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, other): how often something without the shape of an identifier follows, added up within each task."""
    shared = docs.sparkSession.sparkContext.broadcast(slots(patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, counts = zlib.decompress(shared.value), {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pattern", "other"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                for m in followers(text.as_py() or "", bits):
                    counts[m["pattern"]] = counts.get(m["pattern"], 0) + m["fresh"]
                if len(counts) > TASK_PATTERNS:
                    yield flush()
        yield flush()

    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "pattern string, other bigint")
    return found.groupBy("pattern").agg(F.sum("other").alias("other")).join(patterns.select("pattern"), "pattern")


def discovered(docs: DataFrame, scanned: DataFrame, trusted: DataFrame) -> DataFrame:
    """Followers of any shape after the patterns that they leave sure enough: (doc_id, text_key, start, end).

    Patterns are judged on counts first; only what follows those that stay sure is read out, in another scan.
    """
    seen = scanned.select(F.explode("mentions").alias("m")).select("m.pattern", F.col("m.kind").isNotNull().alias("seed"))
    shaped = seen.groupBy("pattern").agg(
        F.sum(F.col("seed").cast("int")).alias("seeds"), F.sum((~F.col("seed")).cast("int")).alias("shaped")
    )
    other = count_followers(docs, trusted)
    share = (F.col("seeds") + F.col("confidence") * F.col("shaped")) / (F.col("seeds") + F.col("shaped") + F.col("other"))
    sure = trusted.join(shaped, "pattern").join(other, "pattern").filter(share >= MIN_CONFIDENCE)
    sure = materialize(sure.select("pattern"), "pii-sure")
    if sure.isEmpty():
        return scanned.select("doc_id", "text_key", F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end")).limit(0)
    return scan_followers(docs, sure).filter("named").select("doc_id", "text_key", "start", "end")


def graph(scanned: DataFrame) -> DataFrame:
    """Edges of patterns and instances: how often they meet, and whether the instance is a seed."""
    seen = scanned.select(F.explode("mentions").alias("m")).select("m.*").filter(F.col("pattern").isNotNull())
    return seen.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("kind").isNotNull()).alias("seed"))


def scored(edges: DataFrame, rounds: int = ROUNDS, confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Patterns with enough seeds whose confidence after the rounds is high enough, with that confidence."""
    strong = edges.groupBy("pattern").agg(F.sum(F.col("seed").cast("int")).alias("seeds")).filter(F.col("seeds") >= MIN_SEEDS)
    edges = materialize(edges.join(strong.select("pattern"), "pattern"), "pii-edges")
    sure = F.when(F.col("seed"), 1.0).otherwise(0.0)
    scores = edges.groupBy("instance").agg(F.max(sure).alias("sure"))
    patterns = None
    for _ in range(rounds):
        patterns = edges.join(scores, "instance").groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("sure")) / F.sum("n")).alias("confidence")
        )
        patterns = materialize(patterns, "pii-patterns")
        scores = edges.join(patterns, "pattern").groupBy("instance").agg(
            F.max(F.greatest(sure, F.col("confidence"))).alias("sure")
        )
    return patterns.filter(F.col("confidence") >= confidence)


def trusted_patterns(scanned: DataFrame, rounds: int = ROUNDS, confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One step of the bootstrapping: patterns that the base matches make sure."""
    return scored(graph(scanned), rounds, confidence)


def bootstrapped(scanned: DataFrame) -> DataFrame:
    """Patterns that base matches, or identifiers found behind patterns already accepted, make sure.

    Each step takes what follows an accepted pattern as a seed for all its other patterns, and scores anew. Accepted
    patterns stay, with the confidence they came in with; the steps end when none is new.
    """
    edges = materialize(graph(scanned), "pii-graph")
    trusted = materialize(scored(edges), "pii-trusted")
    held = new = trusted.count()
    while new:
        found = edges.join(trusted.select("pattern"), "pattern").select("instance", F.lit(True).alias("found")).distinct()
        grown = edges.join(found, "instance", "left").withColumn("seed", F.col("seed") | F.col("found").isNotNull()).drop("found")
        again = scored(grown).join(trusted.select("pattern"), "pattern", "left_anti")
        trusted = materialize(trusted.unionByName(again), "pii-trusted")
        new = trusted.count() - held
        held += new
    return trusted


def _count_of(kind: int) -> Column:
    return F.size(F.filter("base", lambda m: m["kind"] == kind))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda m: F.struct(m["start"], m["kind"], m["end"])))
    return F.array_join(
        F.transform(ordered, lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["start"].cast("string"), m["end"].cast("string"))), ","
    )


def find(docs: DataFrame) -> DataFrame:
    """Per row: counts of the base kinds, digest of the base spans, all spans as text."""
    scanned = materialize(scan(docs), "pii-mentions")
    trusted = bootstrapped(scanned)
    loose = (
        scanned.select("doc_id", "text_key", F.explode(F.filter("mentions", lambda m: m["kind"].isNull())).alias("m"))
        .select("doc_id", "text_key", "m.start", "m.end", "m.pattern")
        .join(trusted.select("pattern"), "pattern")
        .drop("pattern")
    )
    if not trusted.isEmpty():
        loose = loose.unionByName(discovered(docs, scanned, trusted))
    # A span within a wider one is part of it.
    earlier = Window.partitionBy("doc_id", "text_key").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    loose = loose.distinct().withColumn("reach", F.max("end").over(earlier)).filter("reach is null or end > reach")
    loose = (
        loose.groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("start", "end", F.lit(KINDS.index("context")).alias("kind"))).alias("added"))
        .withColumnsRenamed({"doc_id": "_doc", "text_key": "_key"})
    )
    base = F.transform(
        F.filter("mentions", lambda m: m["kind"].isNotNull()), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind"))
    )
    rows = scanned.join(
        loose, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key")), "left"
    ).select("doc_id", base.alias("base"), "added")
    counts = [_count_of(k).cast("bigint").alias(f"n_{KINDS[k]}") for k in range(4)]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))).alias("spans"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))


QUERIES = {"op5_pii": op5_pii}
ORACLE: dict[str, str] = {}
