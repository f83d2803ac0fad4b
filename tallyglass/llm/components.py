"""Connected components by alternating stars: built-in joins and aggregates, logarithmic rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.workspace import materialize


def star_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``vertex`` and ``root`` (its component's least vertex) of all vertices of ``a``-``b`` edges.

    Every round connects each vertex's larger neighbours to its least one and then its smaller ones, until
    the edges are stars. Least neighbours are added up map-side; a hub's neighbours are joined to its least
    one by a join whose skewed keys Spark splits.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    pairs = materialize(pairs, label)
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # A vertex that is its own least one keeps its star: its larger neighbours point at it.
        large = large.filter("a <> b").distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        pairs = materialize(small.unionByName(floor.select("a", F.col("m").alias("b"))).distinct(), label)
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = pairs.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(roots)
