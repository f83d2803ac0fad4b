"""Hard negatives by Fagin's threshold algorithm.

Rows are dealt by a digest into shards of about ``SHARD_ROWS``; anchors travel to every shard in blocks. A shard keeps,
for each dimension, its candidates sorted by that component. An anchor reads each list from the end that its own
component's sign favours (sorted access), a round deeper on all dimensions at a time, and scores every row it meets for
the first time as a whole (random access, exact whole numbers). The scores of the lists' last read entries add up to
the threshold, which no unread row can pass. A window of scores is settled once the threshold falls strictly below the
k-th score found in it, or below the window itself; an anchor leaves a shard when all its windows are settled or all
candidates are read. The shards' best rows of a window meet in one ranking per window, at most k rows of each shard.

A first run finds each anchor's ``positives``, its best rows of the same label (a window without bounds). A second run
finds, for each different score of a positive, the ``k`` best rows of other labels within ``low`` to ``high`` percent
of it. Ties go to the smaller ``vec_id``.

Rows whose label or vector is null, or whose vector holds a null or non-finite component, and rows with a null id take
no part. Vectors of unequal length count as filled up with zeros. Other rows of an anchor are rows of another id. Rows
that repeat an id are all candidates; an id is an anchor once, by its least (label, vector). Rows that are equal in
id, label and vector travel as one row with a count, of which at most as many as a window can return are unfolded
again. Tables without rows or anchors give no rows; an anchor without positives or negatives gives none. Scores
are 64-bit; larger ones raise. Further columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.llm.common import table
from tallyglass.llm.topk import matrix
from tallyglass.workspace import materialize

K = 10
POSITIVES = 5
SCALE = 256
LOW, HIGH = 30, 90
SHARD_ROWS = 8192
ANCHOR_BLOCK = 256
FIRST_DEPTH = 16
FOUND = "anchor_id bigint, mark bigint, vec_id bigint, score bigint"


def labelled_vectors(rows: DataFrame, label, scale: int = SCALE) -> DataFrame:
    """Id, label and scaled whole components of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    vector = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    return rows.filter(ok & finite).select(F.col("vec_id").cast("bigint"), label.cast("bigint").alias("label"), vector.alias("v"))


class SortedLists:
    """A shard's candidates with one list per dimension, sorted by component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")  # equal scores then come by smaller id
        self.ids, self.labels, whole = ids[order], labels[order], vectors[order]
        self.width = whole.shape[1]
        self.top = int(np.abs(whole).max(initial=0))
        self.whole = whole
        self.rows = whole
        self.by_value = np.argsort(whole, axis=0, kind="stable").T
        self.values = np.sort(whole, axis=0).T

    def exact(self, largest: int) -> None:
        """Hold the rows in the narrowest type in which every score with such anchors is exact."""
        bound = self.top * largest * self.width
        if bound >= 1 << 63:
            raise OverflowError("inner products need more than 64 bits")
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
        self.rows = self.whole.astype(kind)

    def search(self, anchor: np.ndarray, takes: np.ndarray, windows: list[tuple[int | None, int | None]], k: int):
        """The k best candidates in each window of scores: rows (window, place, score).

        ``takes`` marks the candidates; a window is its least and its largest score, None for no bound.
        """
        n = len(self.ids)
        scores = np.zeros(n, np.int64)
        read = ~takes
        ups, downs = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        signed = anchor.astype(self.rows.dtype)
        met = np.empty(0, np.int64)
        open_, depth, last = list(range(len(windows))), 0, 0
        while open_:
            depth = min(n, max(FIRST_DEPTH, 2 * depth))
            if len(ups) + len(downs) == 0:
                depth = n
            fresh = np.zeros(n, bool)
            fresh[self.by_value[ups, n - depth : n - last]] = True
            fresh[self.by_value[downs, last:depth]] = True
            if depth == n:
                fresh[:] = True
            new = np.flatnonzero(fresh & ~read)
            scores[new] = (self.rows[new] @ signed).astype(np.int64)
            read[new] = True
            met = np.concatenate((met, new))
            if depth == n or read.all():
                break
            threshold = int(anchor[ups] @ self.values[ups, n - depth]) + int(anchor[downs] @ self.values[downs, depth - 1])
            last = depth
            seen = scores[met]
            open_ = [w for w in open_ if not self._settled(seen, windows[w], k, threshold)]
        met.sort()
        seen = scores[met]
        for w, (low, high) in enumerate(windows):
            inside = met[_within(seen, low, high)]
            own = scores[inside]
            if len(inside) > k:
                near = own >= np.partition(own, len(own) - k)[len(own) - k]
                inside, own = inside[near], own[near]
            best = np.argsort(-own, kind="stable")[:k]
            yield from zip([w] * len(best), inside[best].tolist(), own[best].tolist())

    @staticmethod
    def _settled(seen: np.ndarray, window: tuple[int | None, int | None], k: int, threshold: int) -> bool:
        low, high = window
        if low is not None and threshold < low:
            return True
        inside = seen[_within(seen, low, high)]
        return len(inside) >= k and threshold < np.partition(inside, len(inside) - k)[len(inside) - k]


def _within(scores: np.ndarray, low: int | None, high: int | None) -> np.ndarray:
    keep = np.ones(len(scores), bool)
    if low is not None:
        keep &= scores >= low
    if high is not None:
        keep &= scores <= high
    return keep


def _score_window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest whole number x with low * score <= 100 * x <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def _visits(shards: DataFrame, anchors: DataFrame, count: int, width: int, same: bool, k: int, percent: tuple[int, int] | None) -> DataFrame:
    """Every anchor in every shard; ``marks`` are the scores that span its windows, if ``percent`` is given."""
    blocks = max(1, math.ceil(anchors.count() / ANCHOR_BLOCK))
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int"))
    asked = dealt.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    held = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def visit(key, rows, asked):
        out = []
        if len(rows) and len(asked):
            lists = SortedLists(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["v"], width))
            anchors = matrix(asked["v"], width)
            lists.exact(int(np.abs(anchors).max(initial=0)))
            for i, (anchor, label) in enumerate(zip(asked["anchor_id"].tolist(), asked["label"].tolist())):
                takes = ((lists.labels == label) if same else (lists.labels != label)) & (lists.ids != anchor)
                marks = [0] if percent is None else list(asked["marks"].iloc[i])
                windows = [(None, None)] if percent is None else [_score_window(m, *percent) for m in marks]
                kept = [(m, w) for m, w in zip(marks, windows) if w[0] is None or w[0] <= w[1]]
                for w, place, score in lists.search(anchors[i], takes, [w for _, w in kept], k):
                    out.append((anchor, kept[w][0], int(lists.ids[place]), score))
        return pd.DataFrame(out, columns=["anchor_id", "mark", "vec_id", "score"]).astype("int64")

    return held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(visit, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, k: int = K, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """Hard negatives of every anchor and positive; both frames as ``labelled_vectors`` gives them."""
    spark = vectors.sparkSession
    copies = vectors.groupBy("vec_id", "label", "v").agg(F.count(F.lit(1)).alias("n"))
    distinct = materialize(copies, "negatives-rows")
    size = distinct.agg(F.sum(F.least("n", F.lit(max(k, positives)))).alias("n"), F.max(F.size("v")).alias("width")).first()
    if not size["n"]:
        return spark.createDataFrame(
            [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        )
    count, width = math.ceil(size["n"] / SHARD_ROWS), max(1, size["width"] or 0)
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("n", F.lit(max(k, positives)).cast("bigint"))))
    spread = distinct.withColumn("copy", again)
    shards = spread.select(F.pmod(F.xxhash64("vec_id", "label", "v", "copy"), F.lit(count)).cast("int").alias("shard"), "vec_id", "label", "v")
    chosen = anchors.groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "v")).alias("a"))
    asked = materialize(chosen.select("anchor_id", "a.label", "a.v"), "negatives-anchors")
    near = _ranked(_visits(shards, asked, count, width, True, positives, None), positives)
    near = materialize(near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    marks = near.groupBy("anchor_id").agg(F.sort_array(F.collect_set("positive_score")).alias("marks"))  # at most `positives`
    sought = materialize(asked.join(marks, "anchor_id"), "negatives-windows")
    hard = _ranked(_visits(shards, sought, count, width, False, k, (low, high)), k)
    hard = hard.select("anchor_id", F.col("mark").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return near.join(hard, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    vectors = labelled_vectors(table(spark, sf_dir, "embeddings"), label)
    return mine(vectors, vectors.filter("vec_id % 100 = 0"))


QUERIES = {"op11_hard_negatives": op11_hard_negatives}
ORACLE = {
    "op11_hard_negatives": f"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), a as (
  select vec_id, label, v from v where vec_id % 100 = 0 qualify row_number() over (partition by vec_id order by label, v) = 1
), s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
    cast(list_sum(list_transform(range(1, least(len(a.v), len(c.v)) + 1), lambda i: a.v[i] * c.v[i])) as bigint) as score
  from a, v c where a.vec_id <> c.vec_id
), p as (
  select anchor_id, vec_id as positive_id, coalesce(score, 0) as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by coalesce(score, 0) desc, vec_id) <= {POSITIVES}
), m as (
  select distinct anchor_id, positive_score from p
), n as (
  select m.anchor_id, m.positive_score, s.vec_id as negative_id, coalesce(s.score, 0) as negative_score,
    row_number() over (partition by m.anchor_id, m.positive_score order by coalesce(s.score, 0) desc, s.vec_id) as rank
  from m join s on s.anchor_id = m.anchor_id and not s.same
    and {LOW} * m.positive_score <= 100 * coalesce(s.score, 0) and 100 * coalesce(s.score, 0) <= {HIGH} * m.positive_score
)
select p.anchor_id, p.positive_id, cast(n.rank as integer) as rank, n.negative_id, p.positive_score, n.negative_score
from p join n on n.anchor_id = p.anchor_id and n.positive_score = p.positive_score where n.rank <= {K}
""",
}
