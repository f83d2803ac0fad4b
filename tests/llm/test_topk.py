import numpy as np
import pytest

from tallyglass.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k):
    ok = [(i, np.floor(1024 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, x in ok:
        if q % 100:
            continue
        found = []
        for i, y in ok:
            if i != q:
                n = min(len(x), len(y))
                found.append((-int(x[:n] @ y[:n]), i))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])}
    return out


def vectors(n, seed, width=8):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=width).astype(np.float32).tolist(), 0) for i in range(n)]


@pytest.mark.parametrize("cell", [4096, 40])
def test_equals_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(topk, "CELL_ROWS", cell)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rows = vectors(600, 1)
    rows += [(600 + i, rows[5][1], 1) for i in range(150)]  # one vector many times
    rows += [(900, None, 0), (None, [1.0] * 8, 0), (901, [1.0, None], 0), (902, [float("nan")] * 8, 0), (903, [float("inf")] * 8, 0)]
    rows += [(1000, [0.5, -0.5], 0), (1001, [], 0)]
    found = topk.whole_vectors(spark.createDataFrame(rows, SCHEMA))
    got = topk.search(found, found.filter("vec_id % 100 = 0"))
    assert {tuple(r) for r in got.collect()} == brute(rows, topk.K)


def test_few_vectors_and_none(spark):
    rows = vectors(4, 2)
    found = topk.whole_vectors(spark.createDataFrame(rows, SCHEMA))
    got = topk.search(found, found.filter("vec_id % 100 = 0"))
    assert {tuple(r) for r in got.collect()} == brute(rows, topk.K)
    none = topk.whole_vectors(spark.createDataFrame([], SCHEMA))
    assert topk.search(none, none).count() == 0
    assert topk.search(found, found.filter("vec_id < 0")).count() == 0


def test_far_cells_are_not_visited(spark):
    """Clustered vectors: the bound leaves most cells out, and the result is still exact."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 16)) * 10
    rows = [(i, (centres[i % 8] + rng.normal(size=16) * 0.01).tolist(), 0) for i in range(800)]
    found = topk.whole_vectors(spark.createDataFrame(rows, SCHEMA))
    got = topk.search(found, found.filter("vec_id % 100 = 0"))
    assert {tuple(r) for r in got.collect()} == brute(rows, topk.K)


def test_repeated_query_ids_and_further_columns(spark):
    """An id asks once, by its least vector; all its rows stay candidates of the others."""
    rows = vectors(250, 6) + [(0, [3.0] + [0.0] * 7, 0), (100, [-1e3] * 8, 1), (0, [-9.0] + [1.0] * 7, 2)]
    rows += [rows[200]] * 3 + [rows[7]] * 2
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("query_id", "v", "pivot", "cell", "rank", "score"):
        frame = frame.withColumn(name, topk.F.lit("kept"))
    found = topk.whole_vectors(frame)
    got = sorted(tuple(r) for r in topk.search(found, found.filter("vec_id % 100 = 0")).collect())
    ok = [(i, np.floor(1024 * np.array(v, np.float32).astype(np.float64)).astype(np.int64).tolist()) for i, v, _ in rows]
    expected = []
    for q in (0, 100, 200):
        x = min(v for i, v in ok if i == q)
        best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q)[: topk.K]
        expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(expected)
