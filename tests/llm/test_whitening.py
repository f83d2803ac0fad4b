import numpy as np
import pytest

from tallyglass.llm import whitening
from tests.llm.helpers import with_clashes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def whole(rows, width=None):
    kept = [(i, np.array(v, np.float32).astype(np.float64)) for i, v, _ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in kept), default=0)
    x = np.array([np.floor(1024 * np.pad(v, (0, width - len(v)))).astype(np.int64) + 100_000 for _, v in kept]).reshape(len(kept), width)
    return [i for i, _ in kept], x


def check(got, rows, components):
    ids, x = whole(rows)
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    table = {}
    for r in got:
        table.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
        assert r.n == n and 0 <= r.identity_error <= 1e-4
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(centred.T @ centred / n), rel=1e-9)
    assert len(got) == n * components
    expected = centred @ vectors / np.sqrt(values)
    for c in range(components):
        signs = set()
        for i, row, e in zip(ids, x.tolist(), expected[:, c]):
            deviation = sum((n * a - int(b)) ** 2 for a, b in zip(row, s))
            found = table[(i, deviation)][c + 1]
            assert all(abs(abs(f.whitened) - abs(e)) < 1e-7 * max(1, abs(e)) for f in found)
            signs |= {np.sign(f.whitened * e) for f in found if abs(e) > 1e-3}
        assert len(signs) <= 1


def vectors(n, seed, width=16):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
    scale = 1.0 / np.arange(1, width + 1)
    return [(i, (rng.normal(size=width) * scale @ turn).astype(np.float32).tolist(), 0) for i in range(n)]


def test_equals_direct_eigenvectors(spark):
    rows = vectors(500, 1)
    rows += [(900, None, 0), (901, [1.0, None] + [0.0] * 14, 0), (902, [float("nan")] * 16, 0), (903, [float("inf")] * 16, 0)]
    rows += [rows[3], rows[3], (None, rows[4][1], 1), (7, rows[9][1], None), (950, [0.5, -0.5], 0)]
    frame = with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(5), "n", "component", "whitened", "white")
    check(whitening.whiten(frame).collect(), rows, 8)


def test_few_dimensions_and_no_variance(spark):
    rows = vectors(60, 2, width=3)
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), rows, 3)
    flat = [(i, [float(x[0]), 0.25, -float(x[0])], 0) for i, x in enumerate(np.random.default_rng(3).normal(size=(50, 1)))]
    got = whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r.component for r in got} in ({1}, {1, 2})  # floor leaves at most a little variance beside the line
    for none in ([], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(5)], [(1, None, 0)], [(1, [], 0)]):
        empty = whitening.whiten(spark.createDataFrame(none, SCHEMA))
        assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


@pytest.mark.parametrize("width", [1, 2, 5, 40])
def test_inertia_counts_eigenvalues(width):
    rng = np.random.default_rng(width)
    a = rng.normal(size=(width, width))
    matrix = a @ a.T
    values = np.linalg.eigvalsh(matrix)
    inertia = whitening.Inertia(matrix)
    for shift in np.concatenate((rng.uniform(-1, values[-1] * 1.1, 50), (values[1:] + values[:-1]) / 2)):
        assert inertia.above(shift) == int((values > shift).sum())


@pytest.mark.parametrize("kind", ["spread", "cluster", "equal", "one"])
def test_contour_finds_every_eigenpair(spark, kind):
    rng = np.random.default_rng(7)
    width = 30
    values = {
        "spread": np.linspace(1, 100, width),
        "cluster": np.concatenate((np.full(20, 5.0) + 1e-4 * rng.random(20), 50 + 1e-3 * np.arange(10))),
        "equal": np.concatenate((np.ones(18), np.full(12, 9.0))),
        "one": np.concatenate((np.full(29, 1e-3), [1e6])),
    }[kind]
    turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors_ = whitening.leading(spark, matrix, 8)
    np.testing.assert_allclose(found, np.sort(values)[::-1][:8], rtol=1e-9, atol=1e-9 * values.max())
    np.testing.assert_allclose(vectors_.T @ vectors_, np.eye(8), atol=1e-10)
    np.testing.assert_allclose(matrix @ vectors_, vectors_ * found, atol=1e-9 * values.max())


def test_missed_eigenvalues_raise():
    with pytest.raises(ArithmeticError):
        whitening.contour(np.diag([1.0, 2.0, 3.0, 10.0]), 0.5, 4.0, 4)


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(i, [float(x) * 1e6, float(x), 1.0], 0) for i, x in enumerate(np.random.default_rng(1).normal(size=40))]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert got and any(r.deviation is None for r in got)
