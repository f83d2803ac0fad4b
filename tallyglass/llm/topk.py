"""Exact top-k by inner product with a pivot-distance index.

A vector gets one more component so that all indexed vectors have one length; the largest inner product is
then the smallest distance. Vectors are keyed by their nearest pivot and their distance to it; a cell is a
range of distances of one pivot, cut again by a digest where equal distances pile up. By the triangle
inequality a query can skip a cell whose ring lies farther from the query's own ring than the distance of
its k-th best vector so far. A first pass over the nearest cell of each query gives that distance; the second
visits the rings it leaves, queries in blocks. Scores are whole numbers, computed exactly.

Pivots are ``PIVOTS`` vectors chosen by a digest of their id. Vectors that are null, hold null or
non-finite components, or have a null id take no part; of vectors of unequal length the shorter counts as
filled up with zeros. Rows that repeat an id are all candidates, none for a query of that id; an id is a query once,
by its least vector. Ties go to the smaller id. Tables without vectors or queries give no rows. Further columns are left out.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.llm.common import table
from tallyglass.workspace import materialize

K = 10
SCALE = 1024
PIVOTS = 16
CELL_ROWS = 4096
MAX_RINGS = 256
QUERY_BLOCK = 1024
SLACK = 1e-6
RESULT = "query_id bigint, vec_id bigint, score bigint"


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """Ids and scaled whole components of the vectors that take part."""
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    vector = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    return rows.filter(ok & finite).select(F.col("vec_id").cast("bigint"), vector.alias("v"))


def matrix(column, width: int):
    """Vectors as rows of whole numbers, filled up with zeros."""
    import numpy as np

    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def products(a, b):
    """Exact inner products; through doubles where no sum can pass 2^53."""
    import numpy as np

    if len(a) and len(b) and int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def best(query_ids, q, vec_ids, v, k: int):
    """Rows (query, vector, score) of each query's k best vectors other than itself."""
    import numpy as np

    scores = products(q, v)
    out = []
    for i, query in enumerate(query_ids):
        keep = np.flatnonzero(vec_ids != query)
        s, ids = scores[i, keep], vec_ids[keep]
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            near = s >= least
            s, ids = s[near], ids[near]
        order = np.lexsort((ids, -s))[:k]
        out.append(pd.DataFrame({"query_id": query, "vec_id": ids[order], "score": s[order]}))
    return out


class Index:
    """Pivots, the common length, and each vector's pivot, distance and cell."""

    def __init__(self, vectors: DataFrame):
        norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
        self.rows = materialize(vectors.withColumn("norm", norm), "topk-vectors")
        stats = self.rows.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top"), F.max(F.size("v")).alias("width")).first()
        self.count, self.top, self.width = stats["n"], stats["top"] or 0.0, max(1, stats["width"] or 0)
        chosen = self.rows.dropDuplicates(["v"]).orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
        self.pivots = [(r["v"], r["norm"]) for r in chosen]
        self.cells = None

    def distances(self, v, norms, lifted: bool):
        """Distance of each row to each pivot; queries are not lifted, their extra component is 0."""
        import numpy as np

        p = matrix([x for x, _ in self.pivots], self.width)
        pn = np.array([n for _, n in self.pivots])
        dot = products(v, p).astype(np.float64)
        if lifted:
            extra = np.sqrt(np.maximum(0.0, self.top - norms))[:, None] * np.sqrt(np.maximum(0.0, self.top - pn))[None, :]
            square = 2 * self.top - 2 * (dot + extra)
        else:
            square = norms[:, None] + self.top - 2 * dot
        return np.sqrt(np.maximum(0.0, square))

    def plain(self) -> Index:
        """A copy without DataFrames, for tasks."""
        out = object.__new__(Index)
        out.top, out.width, out.pivots, out.count = self.top, self.width, self.pivots, self.count
        return out

    def keyed(self) -> DataFrame:
        """Vectors with pivot, distance and cell. At most 16 x 256 rings; larger ones are cut by a digest."""
        index = self.plain()

        def near(batches):
            import numpy as np

            for df in batches:
                d = index.distances(matrix(df["v"], index.width), df["norm"].to_numpy(), True)
                pivot = np.argmin(d, axis=1)
                yield df.assign(pivot=pivot.astype(np.int32), distance=d[np.arange(len(df)), pivot])[["vec_id", "v", "pivot", "distance"]]

        placed = materialize(self.rows.mapInPandas(near, "vec_id bigint, v array<bigint>, pivot int, distance double"), "topk-index")
        shares = [i / MAX_RINGS for i in range(1, MAX_RINGS)]
        stats = placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("distance", shares, 10_000).alias("q")).collect()
        ring = F.lit(0)
        for s in stats:  # one row per pivot
            rings = min(MAX_RINGS, math.ceil(s["n"] / CELL_ROWS))
            edges = sorted({s["q"][round(i * MAX_RINGS / rings) - 1] for i in range(1, rings)})
            if edges:
                above = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col("distance")))
                ring = F.when(F.col("pivot") == s["pivot"], above).otherwise(ring)
        ringed = placed.withColumn("ring", ring)
        sizes = ringed.groupBy("pivot", "ring").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("cuts"))
        cut = ringed.join(F.broadcast(sizes), ["pivot", "ring"])  # at most 4096 rows
        cell = F.concat_ws("/", "pivot", "ring", F.pmod(F.xxhash64("vec_id", "v"), F.col("cuts")))
        return materialize(cut.select("vec_id", "v", "pivot", "distance", cell.alias("cell")), "topk-cells")


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The k best rows of ``vectors`` for each row of ``queries`` (both as ``whole_vectors`` gives them)."""
    index = Index(vectors)
    spark = vectors.sparkSession
    if not index.count:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    cells = index.keyed()
    plain = index.plain()
    rings = materialize(
        cells.groupBy("cell", "pivot").agg(F.min("distance").alias("near"), F.max("distance").alias("far"), F.count(F.lit(1)).alias("n")),
        "topk-rings",
    )

    def rays(batches):
        import numpy as np

        for df in batches:
            q = matrix([v[: plain.width] for v in df["v"]], plain.width)
            norms = np.array([float(sum(x * x for x in v)) for v in df["v"]])
            d = plain.distances(q, norms, False)
            for p in range(d.shape[1]):
                yield df.assign(norm=norms, pivot=np.int32(p), ray=d[:, p])[["query_id", "v", "norm", "pivot", "ray"]]

    asked = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = materialize(asked.mapInPandas(rays, "query_id bigint, v array<bigint>, norm double, pivot int, ray double"), "topk-queries")
    gap = F.greatest(F.lit(0.0), F.col("near") - F.col("ray"), F.col("ray") - F.col("far"))
    visits = asked.drop("v").join(rings, "pivot").withColumn("gap", gap)
    blocks = max(1, math.ceil(asked.count() / len(index.pivots) / QUERY_BLOCK))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    texts = asked.filter("pivot = 0").select("query_id", "v")

    def scored(pairs: DataFrame) -> DataFrame:
        """Best k of every visited cell for each of its queries, one task group per cell and query block."""
        named = pairs.withColumn("block", block).join(texts, "query_id")
        wanted = named.select("cell", F.col("block").alias("part")).distinct()
        held = cells.select("cell", "vec_id", "v").join(wanted, "cell")

        def visit(key, held, asked):
            if not len(held) or not len(asked):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
            v, q = matrix(held["v"], plain.width), matrix([x[: plain.width] for x in asked["v"]], plain.width)
            return pd.concat(best(asked["query_id"].to_numpy(), q, held["vec_id"].to_numpy(), v, k))

        return held.groupBy("cell", "part").cogroup(named.select("cell", "block", "query_id", "v").groupBy("cell", "block")).applyInPandas(visit, RESULT)

    first = visits.groupBy("query_id").agg(F.min_by("cell", F.struct(F.col("n") <= k, "gap", "ray", "cell")).alias("cell"))
    tried = scored(first)
    reach = tried.groupBy("query_id").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("least"))
    reach = materialize(reach, "topk-reach")
    bound = F.when(F.col("found") >= k, F.sqrt(F.greatest(F.lit(0.0), F.col("norm") + F.lit(index.top) - 2.0 * F.col("least"))))
    kept = visits.join(reach, "query_id", "left").filter(bound.isNull() | (F.col("gap") <= bound * (1 + SLACK) + SLACK))
    found = scored(kept.select("query_id", "cell"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.filter("vec_id % 100 = 0"))


QUERIES = {"op3_topk": op3_topk}
ORACLE = {
    "op3_topk": f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), q as (
  select vec_id, v from v where vec_id % 100 = 0 qualify row_number() over (partition by vec_id order by v) = 1
), s as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from q, v c where c.vec_id <> q.vec_id
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= {K}
""",
}
