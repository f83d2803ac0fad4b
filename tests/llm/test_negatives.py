import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyglass.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, positives=5, k=10, low=30, high=90):
    ok = [
        (i, label, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64).tolist())
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, label, v in ok:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for anchor, (label, v) in anchors.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i, other) for i, other, w in ok if i != anchor)
        for s, p in [(-s, i) for s, i, other in scored if other == label][:positives]:
            hard = [(i, -n) for n, i, other in scored if other != label and low * s <= 100 * -n <= high * s]
            out += [(anchor, p, r + 1, i, s, n) for r, (i, n) in enumerate(hard[:k])]
    return sorted(out)


def mined(spark, rows, **options):
    vectors = negatives.labelled_vectors(spark.createDataFrame(rows, SCHEMA), F.col("label"))
    return sorted(tuple(r) for r in negatives.mine(vectors, vectors.filter("vec_id % 100 = 0"), **options).collect())


def clusters(n, seed, width=8, spread=0.5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width))
    return [(i, (centres[i % 4] + spread * rng.normal(size=width)).astype(np.float32).tolist(), int(rng.integers(3))) for i in range(n)]


@pytest.mark.parametrize("shard, block", [(8192, 256), (60, 2)])
def test_equals_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(negatives, "SHARD_ROWS", shard)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", block)
    rows = clusters(500, 1)
    rows += [(600 + i, rows[5][1], i % 3) for i in range(120)]  # one vector many times: ties
    rows += [(900, None, 0), (None, [1.0] * 8, 0), (901, [1.0, None], 0), (902, [float("nan")] * 8, 0), (903, [float("inf")] * 8, 0)]
    rows += [(1000, [0.5, -0.5], 0), (1100, [], 1), (1200, [0.0] * 8, 2), (1300, [1.0] * 8, None)]
    assert mined(spark, rows) == brute(rows)


def test_repeated_ids_and_rows(spark):
    rows = clusters(260, 2)
    rows += [rows[7]] * 40 + [rows[9]] * 3  # equal rows, more than a window can return
    rows += [(100, [0.25] * 8, 1), (100, rows[100][1], 2), (7, [2.0] * 8, 0)]  # other vectors and labels under one id
    random.Random(1).shuffle(rows)
    assert mined(spark, rows) == brute(rows)


def test_hot_label_and_other_limits(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD_ROWS", 100)
    rows = [(i, v, 0 if i % 3 else label) for i, v, label in clusters(400, 3)]
    assert mined(spark, rows, positives=2, k=3, low=10, high=95) == brute(rows, 2, 3, 10, 95)


def test_threshold_stops_early():
    """One dimension carries the score: few candidates are read, the result is that of reading all."""
    rng = np.random.default_rng(4)
    vectors = rng.integers(-3, 4, size=(4000, 6))
    vectors[:, 0] = rng.integers(-1000, 1000, size=4000)
    lists = negatives.SortedLists(np.arange(4000), np.zeros(4000, np.int64), vectors)
    lists.exact(1000)
    read = []
    product = lists.rows

    class Counted(np.ndarray):
        def __getitem__(self, key):
            read.append(len(key))
            return np.asarray(product)[key]

    lists.rows = product.view(Counted)
    anchor = np.array([900, 1, -1, 0, 2, 1])
    got = list(lists.search(anchor, np.ones(4000, bool), [(None, None)], 10))
    whole = vectors @ anchor
    order = np.lexsort((np.arange(4000), -whole))[:10]
    assert [(int(lists.ids[p]), s) for _, p, s in got] == [(int(i), int(whole[i])) for i in order]
    assert sum(read) < 2000


def test_whole_number_windows():
    for score in range(-200, 200):
        low, high = negatives._score_window(score, 30, 90)
        inside = {x for x in range(-300, 300) if 30 * score <= 100 * x <= 90 * score}
        assert inside == set(range(low, high + 1))


def test_nothing_and_further_columns(spark):
    assert mined(spark, []) == []
    rows = clusters(150, 5)
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("shard", "anchor_id", "mark", "score", "v", "rank"):
        frame = frame.withColumn(name, F.lit("kept"))
    vectors = negatives.labelled_vectors(frame, F.col("label"))
    got = sorted(tuple(r) for r in negatives.mine(vectors, vectors.filter("vec_id % 100 = 0")).collect())
    assert got == brute(rows)
    assert negatives.mine(vectors, vectors.filter("vec_id < 0")).count() == 0


def test_scores_beyond_64_bits_raise():
    lists = negatives.SortedLists(np.arange(2), np.zeros(2, np.int64), np.full((2, 4), 1 << 40))
    with pytest.raises(OverflowError):
        lists.exact(1 << 40)
