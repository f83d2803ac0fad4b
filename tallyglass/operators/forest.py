"""Random forests of Spark ML, grown from counted cells instead of rows.

A forest sees a row only through the bins of its features, its label and its weight. Rows that agree in these are one
cell with a count, and what a tree draws of ``n`` such rows, each Poisson(rate) times, is Poisson(n * rate): the same
bagging, over all rows. Bins, thresholds, splits, stopping and pruning are those of ``RandomForestClassifier``: with the
same draws it makes the same nodes. Draws depend on the seed and the tree only, not on partitions. A forest becomes Spark's own model: its nodes are written in Spark's format and loaded.

Rows are read once for all forests, so a forest's cost no longer follows the rows, but trees and cells.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.workspace import scratch_path

# Up to this many rows a forest is fitted from the rows, by Spark.
ROWS_BY_CELL = 100_000
# More cells than this, or more pairs of label and weight, are no gain; then Spark fits from the rows, too.
MAX_CELLS = 100_000
MAX_KINDS = 64
# Spark's forests set their thresholds by so many rows, or the square of the bins.
QUANTILE_ROWS = 10_000
EPSILON = 2.0**-52
NODE = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, "
    "gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)
NODE_TYPE = pa.schema(
    [
        ("treeID", pa.int32()),
        (
            "nodeData",
            pa.struct(
                [
                    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])),
                ]
            ),
        ),
    ]
)
CELL_TYPE = pa.schema([("bins", pa.int32()), ("code", pa.int64()), ("kind", pa.int32()), ("rows", pa.int64())])


@dataclass
class Cells:
    """Cells of one number of bins: bins by feature, label, weight and rows of each; ``edges`` are the thresholds by feature."""

    edges: list[np.ndarray]
    codes: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    rows: np.ndarray


def kinds_of(rows: DataFrame, label: str, weight: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """The pairs of label (0 or 1) and weight in order, and their rows; None if there are others or too many."""
    pair = [F.col(label).cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w")]
    found = rows.groupBy(*pair).agg(F.count(F.lit(1)).alias("rows")).limit(MAX_KINDS + 1).collect()
    if len(found) > MAX_KINDS or any(r.y not in (0.0, 1.0) or r.w is None or not 0 < r.w < math.inf for r in found):
        return None
    found.sort()
    return np.array([(r.y, r.w) for r in found]).reshape(-1, 2), np.array([r.rows for r in found], dtype=np.int64)


def thresholds(rows: DataFrame, weight: str | None, bins: list[int], n: int, total: float, d: int, seed: int) -> dict[int, list[np.ndarray]]:
    """The split candidates of Spark's forests per number of bins and feature, from the very rows that these look at for them.

    ``n`` rows of ``total`` weight lie in partitions that keep their order.
    """
    context, found = rows.sparkSession.sparkContext, {}
    start = context._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    for needed in sorted({max(b * b, QUANTILE_ROWS) for b in bins}):
        share = min(1.0, needed / n)
        looked_at = rows.sparkSession._jsparkSession.createDataFrame(rows._jdf.rdd().sample(False, share, start), rows._jdf.schema())
        weights = (F.col(weight) if weight else F.lit(1.0)).cast("double")
        values = DataFrame(looked_at, rows.sparkSession).select(weights.alias("w"), F.posexplode(vector_to_array("features")).alias("feature", "value"))
        values = values.filter("value != 0").groupBy("feature", "value").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("rows")).collect()
        for b in (b for b in bins if max(b * b, QUANTILE_ROWS) == needed):
            found[b] = [candidates(sorted((r.value, r.w) for r in values if r.feature == f), sum(r.rows for r in values if r.feature == f), share * total, b) for f in range(d)]
    return found


def candidates(values: list[tuple[float, float]], count: int, total: float, bins: int) -> np.ndarray:
    """Thresholds between distinct values with their weights, by the rule of Spark's forests; what is missing from ``total`` is the weight of zeros.

    Few values are all parted from each other. Of many, a threshold is set where the running weight is nearest to the next multiple of the stride.
    """
    if not values:
        return np.empty(0)
    zeros = total - sum(w for _, w in values)
    if zeros > EPSILON * count * 100:
        values = sorted([*values, (0.0, zeros)])
    if len(values) <= bins:
        return np.array([(a + b) / 2 for (a, _), (b, _) in zip(values, values[1:])], dtype=float)
    out, running, target = [], values[0][1], total / bins
    for (before, _), (value, w) in zip(values, values[1:]):
        if abs(running - target) < abs(running + w - target):
            out.append((before + value) / 2)
            target += total / bins
        running += w
    return np.array(out, dtype=float)


def count_cells(rows: DataFrame, label: str, weight: str | None, kinds: np.ndarray, edges: dict[int, list[np.ndarray]]) -> dict[int, Cells]:
    """The cells of ``rows`` for every number of bins, from one pass. ``kinds`` holds every pair of label and weight."""
    labels, weights = np.unique(kinds[:, 0]), np.unique(kinds[:, 1])
    radix = {b: np.cumprod([1, *[len(e) + 1 for e in found]], dtype=np.int64) for b, found in edges.items()}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            kind = np.searchsorted(labels, y) * len(weights) + np.searchsorted(weights, w)
            many = len(labels) * len(weights)
            for b, found in edges.items():
                code = sum(np.searchsorted(e, x[:, f]) * radix[b][f] for f, e in enumerate(found))
                times = np.bincount(code * many + kind)
                cell = np.flatnonzero(times)
                columns = [np.full(len(cell), b, dtype=np.int32), cell // many, (cell % many).astype(np.int32), times[cell]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, CELL_TYPE.types)], schema=CELL_TYPE)

    share = (F.col(weight) if weight else F.lit(1.0)).cast("double")
    seen = rows.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"), share.alias("w"))
    partial = seen.mapInArrow(counted, "bins int, code bigint, kind int, rows bigint")
    table = sorted(partial.groupBy("bins", "code", "kind").agg(F.sum("rows").alias("rows")).collect())
    out = {}
    for b, found in edges.items():
        code, kind, times = (np.array([r[i] for r in table if r.bins == b], dtype=np.int64) for i in (1, 2, 3))
        codes = np.stack([code // radix[b][f] % (len(e) + 1) for f, e in enumerate(found)], axis=1)
        out[b] = Cells(found, codes, labels[kind // len(weights)], weights[kind % len(weights)], times)
    return out


def train_and_test_cells(
    train: DataFrame, test: DataFrame, label: str, weight: str | None, bins: list[int], d: int, seed: int
) -> tuple[dict[int, Cells], dict[int, Cells] | None] | None:
    """Cells of both tables by number of bins. None for few training rows, or if cells are no gain; None for the test alone if its labels or weights are odd."""
    kinds = kinds_of(train, label, weight)
    if kinds is None or len(set(kinds[0][:, 0])) < 2 or (n := int(kinds[1].sum())) <= ROWS_BY_CELL:
        return None
    if not (bins := [b for b in bins if b**d * len(kinds[0]) <= MAX_CELLS]):
        return None
    edges = thresholds(train, weight, bins, n, float(kinds[0][:, 1] @ kinds[1]), d, seed)
    held_out = kinds_of(test, label, weight)
    usable = held_out is not None and len(held_out[0]) > 0
    return count_cells(train, label, weight, kinds[0], edges), count_cells(test, label, weight, held_out[0], edges) if usable else None


def as_rows(cells: Cells, spark: SparkSession, key: str, label: str, weight: str) -> DataFrame:
    """One row per cell, for a model of these cells: features inside its bins, and the weight of all its rows."""
    inside = [np.append(e, math.inf) for e in cells.edges]
    x = np.stack([inside[f][cells.codes[:, f]] for f in range(len(inside))], axis=1).tolist()
    table = pa.table({"key": np.arange(len(x)), "x": pa.array(x, pa.list_(pa.float64())), "label": cells.label, "weight": cells.weight * cells.rows})
    named = F.col("key").alias(key), array_to_vector("x").alias("features"), F.col("label").alias(label), F.col("weight").alias(weight)
    return spark.createDataFrame(table).select(*named).coalesce(1)


def impurity_of(stats: np.ndarray, kind: str) -> np.ndarray:
    """Gini impurity or entropy (bits) of class weights in the last axis; 0 without weight."""
    total = stats.sum(axis=-1, keepdims=True)
    share = np.divide(stats, total, out=np.zeros_like(stats), where=total > 0)
    if kind == "gini":
        return np.where(total[..., 0] > 0, 1.0 - (share * share).sum(axis=-1), 0.0)
    return -(share * np.log2(share, out=np.zeros_like(share), where=share > 0)).sum(axis=-1)


def grow(cells: Cells, draws: np.ndarray, settings: dict, source: np.random.Generator) -> list[dict]:
    """One tree over ``draws`` rows of each cell: its nodes as Spark saves them, a parent before its children, left ones first."""
    used = np.flatnonzero(draws)
    codes = cells.codes[used]
    stats = np.zeros((len(used), 3))
    stats[np.arange(len(used)), cells.label[used].astype(int)] = draws[used] * cells.weight[used]
    stats[:, 2] = draws[used]
    kind, d = settings["impurity"], len(cells.edges)

    def best_split(at: np.ndarray, impurity: float) -> tuple | None:
        best = None
        among = range(d) if settings["features"] >= d else sorted(source.choice(d, settings["features"], replace=False))
        for f in among:
            splits = len(cells.edges[f])
            if not splits:
                continue
            table = np.stack([np.bincount(codes[at, f], stats[at, c], splits + 1) for c in range(3)], axis=1).cumsum(axis=0)
            left, right = table[:-1], table[-1] - table[:-1]
            (wl, wr), small = (s[:, :2].sum(axis=1) for s in (left, right)), settings["min_rows"]
            fine = (left[:, 2] >= small) & (right[:, 2] >= small) & (wl >= settings["min_weight"]) & (wr >= settings["min_weight"])
            total = np.where(wl + wr > 0, wl + wr, 1.0)
            gain = impurity - wl / total * impurity_of(left[:, :2], kind) - wr / total * impurity_of(right[:, :2], kind)
            gain = np.where(fine & (gain >= settings["min_gain"]), gain, -math.inf)
            i = int(np.argmax(gain))
            if best is None or gain[i] > best[0]:
                best = float(gain[i]), int(f), i
        return best if best and best[0] > -math.inf else None

    def node(at: np.ndarray, depth: int) -> dict:
        sums = stats[at].sum(axis=0)
        impurity = float(impurity_of(sums[:2], kind))
        made = {"prediction": float(np.argmax(sums[:2])), "impurity": impurity, "impurityStats": sums[:2].tolist(), "rawCount": int(sums[2]), "children": None}
        if depth == settings["depth"] or (depth and abs(impurity) < EPSILON):
            return made
        gain, f, i = best_split(at, impurity) or (None, None, None)
        if gain is None or gain <= 0:
            return made if gain is not None else {**made, "impurity": -1.0}  # Spark's mark where no split is allowed
        lower = codes[at, f] <= i
        children = node(at[lower], depth + 1), node(at[~lower], depth + 1)
        if all(c["children"] is None for c in children) and children[0]["prediction"] == children[1]["prediction"]:
            return {**made, "prediction": children[0]["prediction"]}  # as Spark prunes
        return {**made, "children": children, "gain": gain, "split": {"featureIndex": f, "leftCategoriesOrThreshold": [float(cells.edges[f][i])], "numCategories": -1}}

    out: list[dict] = []

    def number(tree: dict) -> int:
        row = {"id": len(out), "gain": -1.0, "leftChild": -1, "rightChild": -1, "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        children = tree.pop("children")
        out.append(row | tree)
        if children:
            saved = out[row["id"]]
            saved["leftChild"], saved["rightChild"] = number(children[0]), number(children[1])
        return row["id"]

    number(node(np.arange(len(used)), 0))
    return out


def features_per_node(strategy: str, d: int) -> int | None:
    """How many features a node may look at, as Spark counts them for a classifier of several trees; None for other strategies."""
    counts = {"auto": math.ceil(math.sqrt(d)), "sqrt": math.ceil(math.sqrt(d)), "log2": max(1, math.ceil(math.log2(d))), "onethird": math.ceil(d / 3), "all": d}
    return counts.get(strategy)


def served(classifier: RandomForestClassifier, cells: dict[int, Cells] | None) -> bool:
    """Whether ``fit`` can grow this classifier's forest from ``cells``."""
    found = (cells or {}).get(classifier.getMaxBins())
    known = found is not None and features_per_node(classifier.getFeatureSubsetStrategy(), len(found.edges))
    return bool(known) and classifier.getNumTrees() > 1 and classifier.getBootstrap()


def fit(classifier: RandomForestClassifier, spark: SparkSession, cells: dict[int, Cells]) -> RandomForestClassificationModel:
    """The classifier's forest, from the cells of its number of bins. Trees are grown in tasks of their own."""
    found, path = cells[classifier.getMaxBins()], scratch_path(spark, "forest")
    trees, rate, seed = classifier.getNumTrees(), classifier.getSubsamplingRate(), classifier.getSeed() % 2**64
    classifier.write()  # checks the parameters
    saved = {
        "class": "org.apache.spark.ml.classification.RandomForestClassificationModel", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": classifier.uid,
        "paramMap": {p.name: v for p, v in classifier.extractParamMap().items()}, "defaultParamMap": {}, "numFeatures": len(found.edges), "numClasses": 2, "numTrees": trees,
    }
    settings = {
        "impurity": classifier.getImpurity().lower(), "features": features_per_node(classifier.getFeatureSubsetStrategy(), len(found.edges)), "depth": classifier.getMaxDepth(), "min_gain": classifier.getMinInfoGain(),
        "min_rows": classifier.getMinInstancesPerNode(), "min_weight": classifier.getMinWeightFractionPerNode() * float(found.weight @ found.rows),
    }

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                source = np.random.default_rng([seed, tree])
                nodes = grow(found, source.poisson(rate * found.rows), settings, source)
                yield pa.RecordBatch.from_pylist([{"treeID": tree, "nodeData": x} for x in nodes], schema=NODE_TYPE)

    tasks = min(trees, spark.sparkContext.defaultParallelism)
    spark.range(0, trees, 1, tasks).mapInArrow(grown, NODE).write.parquet(f"{path}/data")
    one = {**{k: saved[k] for k in ("timestamp", "sparkVersion", "defaultParamMap")}, "class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel", "paramMap": {}}
    named = F.concat(F.lit(json.dumps({**one, "uid": classifier.uid})[:-2] + "_"), "id", F.lit('"}'))
    spark.range(0, trees, 1, 1).select(F.col("id").cast("int").alias("_1"), named.alias("_2"), F.lit(1.0).alias("_3")).write.parquet(f"{path}/treesMetadata")
    spark.range(0, 1, 1, 1).select(F.lit(json.dumps(saved))).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)
