import hashlib
import random
import re

from tallyglass.llm import fingerprint
from tests.llm.helpers import empty_docs, frame, odd_docs, odd_rows, prose, with_clashes

BLANKS = " \t\n\x0b\f\r"


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def edited(text, after):
    m = len(text) // 3
    return text[: len(text) - m] + after[:m]


def corpus():
    rng = random.Random(9)
    rows = [(3 * i, prose(rng, rng.choice([2, 30, 200, 700])), "en", "s", 0) for i in range(120)]
    for i in range(0, 100, 4):
        words = rows[i][1].split()
        words[len(words) // 2] = "changed"
        rows[i + 1] = (rows[i + 1][0], " ".join(words), "en", "s", 0)
    rows[50] = (rows[50][0], rows[49][1], "en", "s", 0)
    return rows


def test_columns_against_sets(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "ROWS_PER_BUCKET", 7)  # many ranges, so that rows meet across them
    rows = corpus()
    got = {r.doc_id: r for r in fingerprint.fingerprints(frame(spark, rows)).collect()}
    ordered = sorted(rows, reverse=True)
    errors = []
    for (doc, text, *_), (_, after, *_) in zip(ordered, ordered[1:] + ordered[:1]):
        r, change = got[doc], edited(text, after)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(change.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 512
        errors += [r.near_edited - jaccard(text, change), r.near_next - jaccard(text, after)]
        if text == after:
            assert r.near_next == 1
    assert max(map(abs, errors)) < 0.2 and abs(sum(errors) / len(errors)) < 0.01
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.035
    assert got[rows[49][0]].fingerprint == got[rows[50][0]].fingerprint


def test_fingerprint_by_definition(spark):
    """Filled bins hold their least hash, empty ones the low bits of a filled bin."""
    df = frame(spark, [(1, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "en", "s", 0)])
    df = fingerprint.with_shingles(fingerprint.with_words(df, "text", "w"), "w", "s")
    row = fingerprint.with_fingerprint(df.select("s", "text"), "text", "f").first()
    least = {}
    for h in row.s:
        b = (h >> 56) + 128
        least[b] = min(h, least.get(b, h))
    lows = {h & 255 for h in least.values()}
    assert len(row.f) == 256
    for b, code in enumerate(row.f):
        assert code + 128 == least[b] & 255 if b in least else code + 128 in lows


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark), "_h", "_own", "edited", "fingerprint")
    got = fingerprint.fingerprints(docs).collect()
    rows = odd_rows()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[2][0].fingerprint == "" and by_id[3][0].n_chars == 0
    assert len({r.fingerprint for r in by_id[6]}) == 1 and by_id[1][0].fingerprint == by_id[6][0].fingerprint
    # 3, 2: both without words
    assert by_id[3][0].near_next == 1.0 and by_id[2][0].near_next == 0.0
    assert by_id[None][0].edited_sha256 == hashlib.sha256(edited("a row without id", rows[9][1]).encode()).hexdigest()


def test_single_and_empty(spark):
    one = fingerprint.fingerprints(frame(spark, [(5, "abcdef", None, None, 6)])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    assert fingerprint.fingerprints(empty_docs(spark)).count() == 0


def test_no_python_on_the_main_path(spark, sf_dir):
    plan = fingerprint.op6_fingerprint(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
