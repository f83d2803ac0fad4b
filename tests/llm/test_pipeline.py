from collections import Counter

import corpus_pipeline as pipeline
from tallyglass.llm.common import DOCUMENT_COLUMNS
from tallyglass.workspace import materialize
from tests.llm import test_linededup, test_mixing, test_ngramjoin, test_packing
from tests.llm.helpers import frame, near_copies, odd_rows
from tallyglass.llm import mixing


def corpus():
    rows = near_copies(8, groups=6, singles=20)
    clean = [(d, t.replace(" ", "\n", 1) if d % 3 else t, la, f"src{d % 4}", len(t)) for d, t, la, _, _ in rows]
    return clean + [(1000 + (r[0] or 0), *r[1:]) for r in odd_rows() if r[0] is not None]


def test_stages_against_brute_force(spark):
    docs = frame(spark, corpus())
    held = {}
    for name, stage in pipeline.STAGES:
        before = [tuple(r) for r in docs.select(*DOCUMENT_COLUMNS).collect()]
        out = materialize(stage(spark, docs, "unused"), f"test-{name}")
        held[name] = (before, out.collect())
        if name != "packing":
            assert out.columns == DOCUMENT_COLUMNS
        docs = out

    before, after = held["language_id"]
    assert {r.doc_id for r in after} == {r[0] for r in before if any(c.isalpha() for c in r[1] or "")}
    before, after = held["line_dedup"]
    want = test_linededup.brute(before)
    texts = {(r[0], r[1]): want[r[0], r[1]] for r in before}
    kept = {d: t for (d, old), t in texts.items() if t == old or t.strip(" \t\n\x0b\f\r")}
    assert {r.doc_id: r.text for r in after} == kept and all(r.n_chars == len(r.text) for r in after)
    before, after = held["near_copies"]
    assert {r.doc_id for r in after} == {c for d, _, c in test_ngramjoin.brute(before)}
    before, after = held["mixing"]
    rates = mixing.repetition_rates(frame(spark, before), mixing.TARGET_WEIGHTS, "source")
    want = Counter({r[0]: test_mixing.draw(r[0], rates[r[3]]) if r[3] in rates else 1 for r in before})
    assert Counter(r.doc_id for r in after) == +want
    before, after = held["packing"]
    lengths = Counter()
    for r in after:
        lengths[r.doc_id] += r.length
    want = Counter()
    for doc, text, *_ in before:
        want[doc] += len(test_packing.plain_ids(test_packing.BYTE, text or "")) + 1
    assert lengths == want


def test_run_on_a_table(spark, sf_dir):
    out = pipeline.run(spark, sf_dir)
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0
