"""Line dedup by an exact set-similarity join, in built-in functions only.

A line's tokens are its 5-word shingles (all its words, where there are fewer). A line goes if an earlier line
(by document id, digest of the text, place) has the same words or token sets with Jaccard similarity of at
least 0.75. Tokens are ordered by rarity: a fixed array of counters, added up over all lines, gives each token
a level, and the hash decides within a level. Two similar lines share tokens among the rarest third of each
(prefix filter): with prefixes longer by a tenth of the set, about a tenth of their tokens. A line that shares
fewer with all others together is dropped, and again, as what is left shares less. The place of a shared token
and the sizes bound what two lines can have in common (positional and length filter); what is left is verified
on whole sets.

Lines with equal words are one class, named by its earliest line, before anything is joined. The classes that are left
take new prefixes by the exact frequency of every token among them: a passage that many lines hold leaves the prefixes
of lines that have much else, and a class that shares fewer than 75 % of its tokens with all others drops out. In each group of
classes that share a prefix token all others are first held against the earliest; a class that finds its
match there is done, so a group of copies costs a row per member. Only the rest meet each other.

Lines without words are never removed. Null texts stay null. Rows that repeat both id and text are treated
alike. Null ids come last. An empty table gives no rows. Further columns stay, but for those named ``n_lines``
and ``n_removed``, which are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.llm.common import DOCUMENT_COLUMNS, table
from tallyglass.llm.fingerprint import SHINGLE, with_shingles
from tallyglass.workspace import checked_broadcast, materialize

COUNTERS = 1 << 16
LEVELS = 16
LEVEL_SHIFT = 59
EXTRA = 10
PRUNING_ROUNDS = 2
ODD_BLANKS = "\t\x0b\f\r"
# One number or one place list each: 64 MB at most.
MAX_BROADCAST_KEYS = 2_000_000
NO_ID = (1 << 63) - 1
DOC, KEY = "__line_doc", "__line_key"


def keyed(docs: DataFrame) -> DataFrame:
    """Document rows with the order they have here: id (null last) and digest of the text."""
    return docs.withColumns({DOC: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), KEY: F.xxhash64("text")})


def lines_of(docs: DataFrame) -> DataFrame:
    """All lines with words: row keys, place in the text, and word hashes."""
    return with_words(plain_lines(docs)).select(DOC, KEY, "pos", "w")


def plain_lines(docs: DataFrame) -> DataFrame:
    """All lines with words: row keys, place in the text, and the line in lower case with one blank between words."""
    # Once a text, not once a line: neither step makes or moves a line end, and a final sigma ends at one as at the end.
    text = F.col("text")
    odd = [text.contains(c) for c in ODD_BLANKS]
    plain = F.when(odd[0] | odd[1] | odd[2] | odd[3], F.translate("text", ODD_BLANKS, " " * len(ODD_BLANKS))).otherwise(text)
    rows = keyed(docs).select(DOC, KEY, F.posexplode(F.split(F.lower(plain), "\n")).alias("pos", "line"))
    # Looks at the ends of a line only; a filter by the number of words makes Spark split every line twice.
    rows = rows.filter(F.btrim("line") != "")
    line = F.col("line")
    loose = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    single = F.when(loose, F.regexp_replace(F.btrim("line"), " +", " ")).otherwise(line)
    return rows.select(DOC, KEY, "pos", single.alias("line"))


def with_words(lines: DataFrame) -> DataFrame:
    return lines.withColumn("w", F.transform(F.split("line", " "), lambda x: F.xxhash64(x)))


def token_slots(lines: DataFrame) -> DataFrame:
    """The counter of every token of lines with word hashes."""
    w, i = F.col("w"), F.col("i")
    run = F.xxhash64(*[F.get(w, i + k if k else i) for k in range(SHINGLE)])
    # For a plain explode Spark adds a filter by the size of the array, for which it splits and hashes every line again.
    tokens = lines.select("w", F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0)))).alias("i"))
    token = F.when(F.size(w) < SHINGLE, F.xxhash64(w, F.size(w))).otherwise(run)
    return tokens.select(F.pmod(token, F.lit(COUNTERS)).alias("slot"))


def rarity_levels(lines: DataFrame) -> list[int]:
    """Level 0 to 15 of each counter: doublings of its count over twice the mean count. 65,536 numbers."""
    counts = token_slots(lines).groupBy("slot").count().collect()
    mean = sum(r["count"] for r in counts) / COUNTERS
    out = [0] * COUNTERS
    for r in counts:
        out[r["slot"]] = max(0, min(LEVELS - 1, math.ceil(math.log2(r["count"] / (2 * mean))))) if mean else 0
    return out


def with_tokens(lines: DataFrame, levels: list[int]) -> DataFrame:
    """Distinct tokens of a line, rarest first: level above 59 bits of the hash. One text literal holds the levels."""
    table_of = F.split(F.lit(",".join(map(str, levels))), ",").cast("array<bigint>")
    rows = with_shingles(lines, "w", "_s", sort=False)
    ordered = F.transform(
        "_s",
        lambda h: F.shiftleft(F.get(table_of, F.pmod(h, F.lit(COUNTERS)).cast("int")), LEVEL_SHIFT).bitwiseOR(
            F.shiftrightunsigned(h, 64 - LEVEL_SHIFT)
        ),
    )
    return rows.withColumn("tokens", F.sort_array(F.array_distinct(ordered))).drop("_s")


def _least_overlap(n: Column) -> Column:
    """ceil(0.75 n): what a set of n shares at least with a similar one."""
    return F.floor((3 * n + 3) / 4).cast("int")


def prefix(tokens: Column) -> Column:
    """The rarest n - ceil(0.75 n) + k tokens, with k a tenth of n, and one: two similar sets share k of them."""
    n = F.size(tokens)
    return F.slice(tokens, F.lit(1), n - _least_overlap(n) + F.floor(n / EXTRA).cast("int") + 1)


def least_shared(n: Column) -> Column:
    """What a set of n shares at least, within the prefixes, with any similar set (of 0.75 n at least)."""
    return F.floor(_least_overlap(n) / EXTRA).cast("int") + 1


def pruned_enough(before: DataFrame, after: DataFrame) -> bool:
    """Whether a round of pruning left more than half, both being stored: then another one costs more than it spares."""
    return 2 * after.count() > before.count()


def shared_tokens(lines: DataFrame, levels: list[int]) -> DataFrame:
    """(token, class) of prefix tokens that classes share which share enough; the postings move once."""
    sets = with_tokens(lines, levels).select("c", "tokens", least_shared(F.size("tokens")).cast("smallint").alias("least"))
    rows = sets.select("c", "least", F.explode(prefix(F.col("tokens"))).alias("token"))
    dealt = rows.repartition("token")
    # Both sides read all columns, so that they are one exchange; without one, Spark computes and writes the postings twice.
    several = dealt.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.max("least").alias("most"))
    several = several.filter("low <> high and most is not null").select("token")
    rows = materialize(dealt.join(several.hint("shuffle_hash"), "token").distinct(), "line-postings")
    for _ in range(PRUNING_ROUNDS):
        able = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.max("least").alias("m")).filter("n >= m").select("c")
        held = rows.join(able, "c")
        several = held.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high")
        before, rows = rows, materialize(held.join(several.select("token"), "token"), "line-postings")
        if pruned_enough(before, rows):
            break
    return rows.select("token", "c")


def shared_places(sets: DataFrame) -> DataFrame:
    """(token, c, d, first, n, at): prefixes of the given classes by the exact frequency of every token among them.

    Tokens that no other class has come first and need no row; a class that shares fewer than 75 % of its tokens with
    all others together is like none and drops out, and again, as what is left shares less, while a round halves them.
    """
    before, rows = sets, sets.select("c", "d", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    for _ in range(PRUNING_ROUNDS):
        counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
        rows = rows.join(counts, "token")
        able = rows.groupBy("c", "d", "n").agg(F.sort_array(F.collect_list(F.struct("k", "token"))).alias("held"))
        able = materialize(able.filter(F.size("held") >= _least_overlap(F.col("n"))), "line-shared")
        if pruned_enough(before, able):
            break
        before, rows = able, able.select("c", "d", "n", F.explode("held.token").alias("token"))
    alone = F.col("n") - F.size("held")
    some = F.slice("held.token", F.lit(1), F.col("n") - _least_overlap(F.col("n")) + 1 - alone)
    named = able.join(sets.select("c", "d", "first"), ["c", "d"])
    return named.select("c", "d", "first", "n", alone.alias("alone"), F.posexplode(some).alias("i", "token")).select(
        "token", "c", "d", "first", "n", (F.col("alone") + F.col("i")).alias("at")
    )


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Classes whose earlier partner is similar, of candidate pairs (c, e) in order of first lines."""
    later = sets.select("c", "d", F.col("tokens").alias("x"), F.col("first").alias("later"))
    earlier = sets.select(F.col("c").alias("e"), F.col("tokens").alias("y"), F.col("first").alias("sooner"))
    held = pairs.join(later, "c").join(earlier, "e").filter(F.col("sooner") < F.col("later"))
    common = held.withColumn("_n", F.size(F.array_intersect("x", "y")))
    similar = common.filter(F.col("_n") * 100 >= (F.size("x") + F.size("y") - F.col("_n")) * 75)
    return similar.select("c", "d").distinct()


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Row keys and places of the lines to remove."""
    levels = rarity_levels(lines_of(docs))
    # A class is its line as text, so that words are split only where sets are made.
    named = plain_lines(docs).withColumns({"c": F.xxhash64("line"), "d": F.hash("line")})
    stored = materialize(named.select(DOC, KEY, "pos", "c", "d"), "line-classes")
    place = F.struct(DOC, KEY, "pos")
    firsts = materialize(stored.groupBy("c", "d").agg(F.min(place).alias("first")), "line-firsts")

    shared = shared_tokens(with_words(named).select("w", "c"), levels)
    active = checked_broadcast(shared.select("c").distinct(), "line-active", MAX_BROADCAST_KEYS)
    some = named.select("line", "c", "d").join(active, "c", "left_semi").dropDuplicates(["c", "d"])
    sets = with_tokens(with_words(some), levels)
    sets = materialize(sets.select("c", "d", "tokens").join(firsts, ["c", "d"]), "line-sets")

    members = materialize(shared_places(sets), "line-members")
    heads = members.groupBy("token").agg(F.min(F.struct("first", "c")).alias("head"))
    led = members.join(heads, "token").filter(F.col("c") != F.col("head.c")).select("c", F.col("head.c").alias("e")).distinct()
    gone = materialize(verified(led, sets), "line-gone")

    left = members.join(gone, ["c", "d"], "left_anti")
    other = members.select("token", F.col("c").alias("e"), F.col("first").alias("sooner"), F.col("n").alias("m"), F.col("at").alias("bt"))
    n, m = F.col("n"), F.col("m")
    fits = (F.least(n, m) * 100 >= F.greatest(n, m) * 75) & (
        (1 + F.least(n - F.col("at") - 1, m - F.col("bt") - 1)) * 175 >= (n + m) * 75
    )
    pairs = left.join(other, "token").filter((F.col("sooner") < F.col("first")) & (F.col("c") != F.col("e")) & fits)
    more = verified(pairs.select("c", "e").distinct().join(led, ["c", "e"], "left_anti"), sets)
    gone = gone.unionByName(more).withColumn("_gone", F.lit(True))

    judged = stored.join(firsts, ["c", "d"]).join(gone, ["c", "d"], "left")
    return judged.filter(F.col("_gone") | (place > F.col("first"))).select(DOC, KEY, "pos")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Documents without their repeated lines, with ``n_lines`` and ``n_removed``."""
    removed = repeated_lines(docs).groupBy(DOC, KEY).agg(F.collect_set("pos").alias("__line_removed"))
    removed = checked_broadcast(removed, "line-removed", MAX_BROADCAST_KEYS)
    rows = keyed(docs).join(removed, [DOC, KEY], "left")
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("__line_removed", i))
    text = F.when(F.col("__line_removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("bigint")
    out = rows.withColumns({"n_lines": n_lines, "n_removed": F.coalesce(F.size("__line_removed"), F.lit(0)).cast("bigint"), "__line_text": text})
    others = [F.col("__line_text").alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*others, "n_lines", "n_removed")


def op8_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def dedup_sql(source: str = "documents") -> str:
    """``repeated_lines`` in SQL over ``source``: common tables ending in ``cleaned`` (doc_id, text, counts)."""
    return f"""
lines as (
  select doc_id, pos, line, string_split_regex(trim(lower(line), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\\x20\\x09-\\x0D]+') as w
  from (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from {source})
  where trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''
),
classes as (select w, min((doc_id, pos)) as first from lines group by w),
named as (select row_number() over (order by first) as c, w, first from classes),
tokens as (
  select distinct c, case when len(w) < {SHINGLE} then array_to_string(w, ' ') else array_to_string(w[i:i + {SHINGLE - 1}], ' ') end as token,
    len(w) < {SHINGLE} as short
  from (select c, w, unnest(range(1, greatest(1, len(w) - {SHINGLE - 1}) + 1)) as i from named)
),
sizes as (select c, count(*) as n from tokens group by c),
common as (
  select a.c as x, b.c as y, count(*) as n from tokens a join tokens b on a.token = b.token and a.short = b.short and b.c < a.c group by all
),
gone as (
  select distinct x as c from common o join sizes a on a.c = o.x join sizes b on b.c = o.y where 100 * o.n >= 75 * (a.n + b.n - o.n)
),
removed as (
  select l.doc_id, l.pos from lines l join named using (w)
  where c in (select c from gone) or (l.doc_id, l.pos) > first
),
cleaned as (
  select doc_id, text, n_lines, coalesce(len(places), 0) as n_removed,
    case when places is null then text
      else array_to_string(list_transform(list_filter(range(n_lines), lambda i: not list_contains(places, i)), lambda i: string_split(text, chr(10))[i + 1]), chr(10)) end as kept
  from (select doc_id, text, case when text is null then 0 else len(string_split(text, chr(10))) end as n_lines from {source}) d
    left join (select doc_id, list(pos) as places from removed group by doc_id) using (doc_id)
)"""


QUERIES = {"op8_linededup": op8_linededup}
ORACLE = {"op8_linededup": f"with {dedup_sql()} select doc_id, kept as text, n_lines, n_removed from cleaned"}
