import hashlib
import math
from collections import Counter

from tallyglass.llm import mixing
from tests.llm.helpers import empty_docs, frame, odd_docs, with_clashes


def draw(doc, rate, seed=mixing.SEED):
    text = f"{seed}:{'' if doc is None else doc}"
    u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52
    k, term = 0, math.exp(-rate)
    total = term
    while total <= u:
        k += 1
        term *= rate / k
        total += term
    return k


def test_counts_invert_the_poisson_distribution(spark):
    rows = [(i, "x" * (10 + i % 7), "en", "ab c"[i % 4], 0) for i in range(2000)]
    weights = {"a": 0.7, "b": 0.3}
    docs = frame(spark, rows)
    rates = mixing.repetition_rates(docs, weights, "source")
    size = Counter()
    for _, t, _, s, _ in rows:
        size[s] += len(t)
    total = size["a"] + size["b"]
    assert all(abs(rates[s] - weights[s] * total / size[s]) < 1e-12 for s in weights)
    got = Counter(r.doc_id for r in mixing.mix(docs, weights).collect())
    want = {i: draw(i, rates[s]) if s in rates else 1 for i, _, _, s, _ in rows}
    assert got == Counter({i: n for i, n in want.items() if n})
    share = sum(n * len(rows[i][1]) for i, n in got.items() if rows[i][3] == "a") / sum(n * len(rows[i][1]) for i, n in got.items() if rows[i][3] in "ab")
    assert abs(share - 0.7) < 0.05


def test_order_is_global_and_stable(spark):
    docs = frame(spark, [(i, "text", "en", "src0", 4) for i in range(500)]).repartition(7)
    first = [(r.doc_id, r.copy) for r in mixing.mix(docs).collect()]
    assert first == [(r.doc_id, r.copy) for r in mixing.mix(docs.repartition(3)).collect()]
    assert first != sorted(first)


def test_large_rates_are_sums(spark):
    rows = [(i, "x", "en", "small", 1) for i in range(40)] + [(100 + i, "y" * 400, "en", "large", 400) for i in range(40)]
    got = Counter(r.source for r in mixing.mix(frame(spark, rows), {"small": 0.5, "large": 0.5}).collect())
    mean = 40 * 401 * 0.5
    assert abs(got["small"] - mean) < 6 * mean**0.5


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark), "_u", "_n", "n", "rate")
    got = mixing.mix(docs, {"src0": 1.0, "src1": 0.0, "src2": 0.0, "nowhere": 1.0})
    assert got.columns == [*docs.columns, "copy", "shuffle_key"]
    rows = got.collect()
    assert all(r._u == "kept" and r._n == "kept" for r in rows)
    assert {r.doc_id for r in rows} & {None, -9} == {None, -9} and not {r.doc_id for r in rows} & {3, 5, 6}
    assert mixing.mix(empty_docs(spark)).count() == 0


def test_no_python_on_the_main_path(spark, sf_dir):
    plan = mixing.op7_mix(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
