import random
import re

import numpy as np
import pytest

from tallyglass.llm import ngramjoin
from tallyglass.llm.components import star_components
from tests.llm.helpers import empty_docs, frame, near_copies, odd_docs, odd_rows, prose, with_clashes


def word_list(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def shingles(text):
    words = word_list(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 75 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), None if r[0] is None else min(ids)))
    return sorted(out, key=str)


def found(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngramjoin.components(docs).collect()), key=str)


@pytest.mark.parametrize("pool, keys", [(512, 400_000), (8, 0)])
def test_equals_brute_force(spark, monkeypatch, pool, keys):
    """Also with pools so small that all go through first classes and blocks, and joins instead of broadcasts."""
    monkeypatch.setattr(ngramjoin, "POOL_ROWS", pool)
    monkeypatch.setattr(ngramjoin, "MAX_BROADCAST_KEYS", keys)
    for seed in (5, 6):
        rows = near_copies(seed)
        assert found(frame(spark, rows).repartition(5)) == brute(rows)


def test_threshold_is_exact(spark):
    """Sets of 16 and 12 of them: 75 %. With 11: below."""
    words = [f"w{i}" for i in range(20)]
    rows = [(1, " ".join(words), "", "", 0), (2, " ".join(words[:16]), "", "", 0), (3, " ".join(words[:15]), "", "", 0)]
    assert [(c, n) for _, n, c in found(frame(spark, rows))] == [(1, 16), (1, 12), (1, 11)]
    assert [c for *_, c in found(frame(spark, [rows[0], rows[2]]))] == [1, 3]


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark), "c", "root", "chunk", "text_key", "component_id")
    assert found(docs) == brute(odd_rows())
    kept = ngramjoin.first_of_components(docs)
    assert kept.columns == ["doc_id", *[c for c in docs.columns if c != "doc_id"]]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([None, -9, 1, 2, 3, 4, 5, 7, 8], key=str)


def test_empty_table(spark):
    assert ngramjoin.components(empty_docs(spark)).count() == 0
    assert ngramjoin.first_of_components(empty_docs(spark)).count() == 0


def test_hashes_follow_the_words():
    rng = random.Random(1)
    texts = [prose(rng, n) for n in (0, 1, 4, 5, 9, 300)] + [None, "", " \n", "A b\tC  d\x0be\x1cf é", "a b c d e\x1cf é"]
    sets = ngramjoin.shingle_sets(texts)
    alone = [ngramjoin.shingle_sets([t])[0] for t in texts]
    assert all((a == b).all() for a, b in zip(sets, alone))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert (sets[9] == sets[10]).all()
    words, _ = ngramjoin.word_hashes(" ".join(f"x{i:x}" for i in range(200_000)).encode())
    assert len(np.unique(words)) == 200_000


def test_tree_prunes_and_loses_nothing():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(40):
        base = np.unique(rng.integers(0, 1 << 62, rng.integers(3, 300)).astype(np.uint64))
        for _ in range(rng.integers(1, 4)):
            drop = rng.random(len(base)) > 0.1
            sets.append(base[drop] if drop.any() else base)
    root = ngramjoin.tree(sets, list(range(len(sets))))
    calls = []
    real = ngramjoin.linked
    ngramjoin.linked = lambda x, y: (calls.append(1), real(x, y))[1]
    try:
        union = ngramjoin.Union(len(sets))
        ngramjoin.dual_join(root, root, sets, union)
    finally:
        ngramjoin.linked = real
    other = ngramjoin.Union(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if real(sets[i], sets[j]):
                other.join(i, j)
    same = lambda u: [[u.root(i) == u.root(j) for j in range(i)] for i in range(len(sets))]
    assert same(union) == same(other)
    assert len(calls) < len(sets) * (len(sets) - 1) / 20


def test_star_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(200, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(80)]
    got = {r.vertex: r.root for r in star_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    up = {v: v for e in edges for v in e}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    alone = {a for a, b in edges if a == b} - {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: root(v) for v in up if v not in alone}
    assert star_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    rng = random.Random(3)
    text = prose(rng, 3000)
    whole = ngramjoin.shingle_sets([text, "a b c"])
    monkeypatch.setattr(ngramjoin, "SLICE", 500)
    pieces = ngramjoin.shingle_sets([text, "a b c"])
    assert all((a == b).all() for a, b in zip(whole, pieces))
    assert (ngramjoin.shingle_sets(["x" * 5000])[0] == ngramjoin.shingle_sets([" " + "x" * 5000 + " "])[0]).all()


def test_linked_sets_share_what_the_prefix_rule_says():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        x = np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64))
        drop, add = rng.integers(0, len(x) // 4 + 1), rng.integers(0, len(x) // 4 + 1)
        y = np.unique(np.concatenate([x[rng.permutation(len(x))[drop:]], rng.integers(0, 1 << 40, add).astype(np.uint64)]))
        if ngramjoin.linked(x, y):
            common = set(x[: ngramjoin.prefix_size(len(x))]) & set(y[: ngramjoin.prefix_size(len(y))])
            assert len(common) >= max(ngramjoin.least_shared(len(x)), ngramjoin.least_shared(len(y)))


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(9)
    text, *others = [prose(rng, 40) for _ in range(6)]
    kept = lambda rows: sorted(((r.doc_id, r.text) for r in ngramjoin.first_of_components(frame(spark, rows)).collect()), key=str)
    # An id with many texts, of which one is a copy of a smaller id's: only that row goes.
    rows = [(1, text, "en", "s", 0), (7, text, "en", "s", 0), *[(7, t, "en", "s", 0) for t in others]]
    assert kept(rows) == sorted([(1, text), *[(7, t) for t in others]], key=str)
    # Rows that repeat id and text, also with other further columns: one stays.
    rows = [(3, text, "en", f"s{i % 2}", i) for i in range(5)] + [(4, others[0], "en", "s", 0)] * 2 + [(5, "", "en", "s", 0)] * 2
    assert kept(rows) == sorted([(3, text), (4, others[0]), (5, ""), (5, "")], key=str)
    # Null ids: one of a group stays, and none beside an id.
    rows = [(None, text, "en", "s", 0)] * 3 + [(None, others[0], "en", "s", 0), (9, others[0], "en", "s", 0), (None, None, "en", "s", 0)]
    assert kept(rows) == sorted([(None, text), (9, others[0]), (None, None)], key=str)


def test_a_shared_passage_connects_no_pools(spark):
    """Pairs that share much of their own are pools; three shingles that all classes hold connect nothing."""
    rows = [(100 * (c // 2) + i, c, False, 4) for c in range(40) for i in range(10)]
    rows += [(-1 - i, c, True, 4) for c in range(40) for i in range(3)]
    posted = spark.createDataFrame(rows, "token bigint, c bigint, frequent boolean, least int")
    found = ngramjoin.pools(posted).collect()
    assert {(r.c, r.root) for r in found} == {(c, c - c % 2) for c in range(40)}
