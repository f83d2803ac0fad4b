"""Document fingerprints by one-permutation MinHash, in built-in functions only.

Each 5-word shingle is hashed once; the upper bits of the hash name one of 256 bins and every bin keeps its
least hash. An empty bin borrows from the first filled bin on its own fixed sequence of bins, the same for
all documents. The fingerprint packs the low 8 bits of every bin. The share of equal bins, less what equal
low bits occur by chance, estimates the Jaccard similarity of the shingle sets (standard error at most 0.032).

Null texts count as empty. A text without words has the empty fingerprint: like another such text 1, like any
other 0. Fewer than five words are one shingle. Of rows that repeat an id the order is by a digest of the
text; null ids come last. The next document after the last is the first; a single document follows itself.
An empty table gives no rows. Further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.llm.common import table
from tallyglass.workspace import materialize

SHINGLE = 5
BINS = 256
BITS = 8
PROBES = 12
ROWS_PER_BUCKET = 2000
MAX_SEGMENTS = 256
MAX_BUCKETS = 65_536
BLANKS = " \t\n\x0b\f\r"


def with_words(df: DataFrame, text: str, into: str) -> DataFrame:
    """Word hashes of a text (lower case, split at ASCII white space); empty for no words."""
    words = F.split(F.btrim(F.lower(text), F.lit(BLANKS)), "[\\x20\\x09-\\x0D]+")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return df.withColumn(into, F.when(F.btrim(text, F.lit(BLANKS)) != "", hashes).otherwise(F.array().cast("array<bigint>")))


def with_shingles(df: DataFrame, words: str, into: str, size: int = SHINGLE, sort: bool = True) -> DataFrame:
    """Hashes (ascending, if sorted) of all runs of ``size`` words; all words as one run where there are fewer."""
    w = F.col(words)
    runs = F.transform(
        F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k if k else i) for k in range(size)])
    )
    short = F.when(F.size(w) > 0, F.array(F.xxhash64(w, F.size(w)))).otherwise(F.array().cast("array<bigint>"))
    found = F.when(F.size(w) >= size, runs).otherwise(short)
    return df.withColumn(into, F.sort_array(found) if sort else found)


def with_fingerprint(df: DataFrame, text: str, into: str) -> DataFrame:
    """Array of 256 low bytes (less 128), empty for a text without words.

    Each step is a column of its own, read more than once by the next, so that no lambda computes it again.
    """
    shift = 64 - (BINS.bit_length() - 1)
    df = with_shingles(with_words(df, text, "_w"), "_w", "_s").drop("_w")
    bin_of = lambda x: F.shiftright(x, shift)
    first = F.filter("_s", lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col("_s"), i - 1))))
    df = df.withColumn("_f", first).drop("_s")
    number = lambda x: (bin_of(x) + BINS // 2).cast("int")
    byte = lambda x: x.bitwiseAND(F.lit(255).cast("bigint")).cast("int")
    filled = F.transform("_f", lambda x: number(x) * 512 + 256 + byte(x))
    empty = F.array_except(F.sequence(F.lit(0), F.lit(BINS - 1)), F.transform("_f", number))
    df = df.withColumn("_d", F.sort_array(F.concat(filled, F.transform(empty, lambda b: b * 512))))
    has = lambda x: x.bitwiseAND(F.lit(256)) != 0
    low = lambda x: x.bitwiseAND(F.lit(255))

    def borrowed(i: Column) -> Column:
        tries = []
        for r in range(PROBES):
            donor = F.get(F.col("_d"), F.pmod(F.hash(i, F.lit(r)), F.lit(BINS)))
            tries.append(F.when(has(donor), low(donor)))
        nearest = F.array_min(F.transform("_f", lambda x: F.hash(i, number(x)).cast("bigint") * 256 + byte(x)))
        return F.coalesce(*tries, byte(nearest))

    dense = F.transform("_d", lambda x, i: (F.when(has(x), low(x)).otherwise(borrowed(i)) - 128).cast("tinyint"))
    dense = F.when(F.size("_f") > 0, dense).otherwise(F.array().cast("array<tinyint>"))
    return df.withColumn(into, dense).drop("_f", "_d")


def packed(fingerprint: str) -> Column:
    """The fingerprint as hexadecimal text, two digits a bin."""
    digits = F.array(*[F.lit(f"{i:02x}") for i in range(256)])
    return F.array_join(F.transform(fingerprint, lambda x: F.get(digits, x.cast("int") + 128)), "")


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity, corrected for low bits that agree by chance."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    chance = 1.0 / (1 << BITS)
    share = F.greatest(F.lit(0.0), (equal / F.lit(float(BINS)) - chance) / (1.0 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(share)


def id_buckets(docs: DataFrame) -> Column:
    """Ascending bucket numbers of about 2,000 rows each, at most 65,536, from quantiles of all ids."""
    rows = docs.count()
    buckets = max(1, min(MAX_BUCKETS, rows // ROWS_PER_BUCKET))
    segments = min(MAX_SEGMENTS, buckets)
    inner = -(-buckets // segments)
    shares = [i / segments for i in range(1, segments)]
    bounds = docs.agg(F.percentile_approx("doc_id", [0.0, *shares, 1.0], 10_000).alias("q")).first()["q"] or [0, 0]
    longs = lambda values: F.array(*[F.lit(v).cast("bigint") for v in values])
    doc = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    inside = bounds[1:-1]
    segment = F.size(F.filter(longs(inside), lambda b: b < doc)) if inside else F.lit(0)
    low, high = F.get(longs(bounds), segment), F.get(longs(bounds), segment + 1)
    place = F.width_bucket(doc.cast("double"), low.cast("double"), (high + 1).cast("double"), F.lit(inner))
    within = F.when(high > low, place).otherwise(F.lit(0))
    return (segment * F.lit(inner + 2) + (within if inner > 1 else F.lit(0))).cast("int")


def with_next(docs: DataFrame, columns: list[str], bucket: Column) -> DataFrame:
    """Each row with ``next_<column>`` of the document that follows in descending order of ids.

    Rows are dealt by ranges of ids once. The first row of each range is also sent to the range above it
    (one row a range, at most 65,536), where it follows the last row.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("_h")]
    rows = docs.withColumn("_h", F.xxhash64("text")).withColumn("_bucket", bucket)
    heads = materialize(
        rows.select("_bucket", "doc_id").groupBy("_bucket").agg(F.max("doc_id").alias("head")), "fingerprint-heads"
    )
    up = Window.orderBy("_bucket")
    targets = heads.select(
        "_bucket", "head", F.coalesce(F.lead("_bucket").over(up), F.min("_bucket").over(Window.partitionBy())).alias("_target")
    )
    copies = (
        rows.join(F.broadcast(targets), "_bucket")
        .filter(F.col("doc_id").eqNullSafe(F.col("head")))
        .select(*docs.columns, "_h", F.col("_target").alias("_bucket"), F.lit(1).alias("_copy"))
    )
    everything = rows.select(*docs.columns, "_h", "_bucket", F.lit(0).alias("_copy")).unionByName(copies)
    w = Window.partitionBy("_bucket").orderBy("_copy", *order)
    led = everything.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
    return led.filter("_copy = 0").drop("_h", "_bucket", "_copy")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bucket = id_buckets(rows)
    own = with_next(with_fingerprint(rows, "text", "_own"), ["text", "_own"], bucket)
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    out = own.withColumns({"n_chars": n.cast("bigint"), "edited": edited}).drop("text", "next_text")
    out = with_fingerprint(out, "edited", "_edited")
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed("_own").alias("fingerprint"),
        packed("_edited").alias("edited_fingerprint"),
        likeness("_own", "_edited").alias("near_edited"),
        likeness("_own", "next__own").alias("near_next"),
    )


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op6_fingerprint": op6_fingerprint}
ORACLE: dict[str, str] = {}
