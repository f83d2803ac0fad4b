import hashlib
import random
import re

import pyarrow as pa
import pytest

from tallyglass.llm import decontaminate
from tests.llm.helpers import empty_docs, frame, odd_docs, prose, with_clashes

TESTS = "item_id bigint, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute(docs, tests, size=10):
    windows = {}
    for item, text in tests:
        w = split(text)
        for p in range(len(w) - min(size, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[p : p + min(size, len(w))]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, items = split(text), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                found = windows.get(tuple(w[p : p + n]))
                if found:
                    hit |= set(range(p, p + n))
                    items |= found
        named = sorted(str(i) for i in items if i is not None)
        out.append((doc, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def corpus(seed=1, docs=120):
    rng = random.Random(seed)
    tests = [(i, prose(rng, rng.choice([1, 4, 10, 11, 30, 60]))) for i in range(25)]
    tests += [(3, prose(rng, 15)), (40, None), (41, " ... "), (None, prose(rng, 12)), (42, tests[5][1]), (43, "A-b A-b a b a b a b a b a b A b")]
    rows = []
    for i in range(docs):
        text = prose(rng, rng.choice([0, 1, 9, 50, 300]))
        for _ in range(rng.choice([0, 0, 1, 3])):
            whole = split(rng.choice(tests)[1]) or ["x"]
            a = rng.randrange(len(whole))
            part = whole[a : a + rng.choice([5, 9, 10, 14, 60])]
            text = f"{text} {rng.choice([' ', '-', '\n']).join(part).upper()}! {prose(rng, rng.choice([0, 5]))}"
        rows.append((i, text, "en", "src0", 0))
    rows.append((200, " ".join(["a", "b"] * 40), "en", "src0", 0))
    return rows, tests


@pytest.mark.parametrize("shard, block, pairs", [(4_000_000, 16_000_000, 2_000_000), (700, 400, 7)])
def test_equals_brute_force(spark, monkeypatch, shard, block, pairs):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    rows, tests = corpus()
    docs = with_clashes(frame(spark, rows).repartition(3), "spans", "matches", "n_words")
    bench = frame(spark, tests, TESTS)
    got = sorted((tuple(r) for r in decontaminate.digest(decontaminate.scan(docs, bench)).collect()), key=repr)
    expected = brute([(r[0], r[1]) for r in rows], tests)
    assert got == expected
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(e[0] for e in expected if not e[5])


def test_matches_are_longest_and_verbatim(spark):
    rows, tests = corpus(2)
    found = decontaminate.scan(frame(spark, rows), frame(spark, tests, TESTS)).collect()
    texts = {r[0]: split(r[1]) for r in rows}
    items = {}
    for i, text in tests:
        items.setdefault(None if i is None else str(i), []).append(split(text))
    seen = 0
    for r in found:
        w = texts[r.doc_id]
        for m in r.matches:
            part = w[m.doc_start : m.doc_start + m.length]
            assert len(part) == m.length and any(v[m.item_start : m.item_start + m.length] == part for v in items[m.item_id])
            best = 0
            for v in items[m.item_id]:
                for a in range(len(w)):
                    for b in range(len(v)):
                        n = 0
                        while a + n < len(w) and b + n < len(v) and w[a + n] == v[b + n]:
                            n += 1
                        best = max(best, n) if n >= min(10, len(v)) else best
            assert m.length == best
            seen += 1
    assert seen > 20


def test_awkward_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    tests = [(1, "ONE two three"), (2, "漢字 x"), (3, rows[5][1][:4000]), (4, "no such words"), (5, "12345 67890")]
    for bench in (tests, [], [(1, None)], [(1, "?!")]):
        got = decontaminate.digest(decontaminate.scan(docs, frame(spark, bench, TESTS))).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows, bench)
    assert decontaminate.scan(empty_docs(spark), frame(spark, tests, TESTS)).count() == 0


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    """With a hash that sees only the first letter, spelling decides."""
    real = decontaminate.word_hashes

    def weak(data, starts, lengths, longest, seed):
        if seed != 14695981039346656037:
            return real(data, starts, lengths, longest, seed)
        return real(data, starts, lengths.clip(max=1), longest, seed)

    monkeypatch.setattr(decontaminate, "word_hashes", weak)
    tests = decontaminate.Tests(["1"], pa.array(["ax by cz"], pa.large_string()))
    counts, spans, found = decontaminate.shard_report(tests, pa.array(["ax by cz", "aa bb cc", "aa ax by cz bb"], pa.large_string()))
    assert counts.tolist() == [3, 3, 5] and spans == [[(0, 3)], [], [(1, 3)]] and found[1] == {}


def test_suffix_array_orders_suffixes():
    import numpy as np

    rng = random.Random(3)
    text = np.array([rng.choice([0, 1, 2, 3]) for _ in range(400)] + [1, 2] * 50 + [0])

    def suffix(p):
        out = []
        while text[p]:
            out.append(int(text[p]))
            p += 1
        return out

    order = decontaminate.suffix_array(text, 1000)
    assert sorted(order.tolist()) == np.flatnonzero(text).tolist()
    listed = [suffix(p) for p in order]
    assert listed == sorted(listed)


def test_no_shuffle(spark):
    docs, bench = odd_docs(spark), frame(spark, [(1, "one two")], TESTS)
    plan = decontaminate.digest(decontaminate.scan(docs, bench))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
