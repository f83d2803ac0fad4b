import random
import zlib

import numpy as np

from tallyglass.llm import langid
from tallyglass.llm.common import table
from tests.llm.helpers import empty_docs, frame, odd_docs, with_clashes


def is_held_out(doc):
    return zlib.crc32(str(doc).encode()) % 3 == 1


def brute_phrases(text, sample):
    """Phrases of a parse by longest substrings of the sample, in stretches."""
    n = 0
    for a in range(0, len(text), langid.STRETCH):
        stretch = text[a : a + langid.STRETCH]
        i = 0
        while i < len(stretch):
            j = i + 1
            while j <= len(stretch) and stretch[i:j] in sample:
                j += 1
            i = max(i + 1, j - 1)
            n += 1
    return n


def test_phrases_equal_longest_substring_matches():
    rng = np.random.default_rng(3)
    sample = bytes(rng.integers(0, 4, 300).tolist())
    steps = langid.phrase_steps(langid.suffix_automaton(np.frombuffer(sample, np.uint8), 6))
    texts = [bytes(rng.integers(0, 5, n).tolist()) for n in (0, 1, 7, 400, langid.STRETCH, 2500)]
    grid, lengths, owner = [], [], []
    for i, t in enumerate(texts):
        for a in range(0, len(t), langid.STRETCH):
            part = t[a : a + langid.STRETCH]
            grid.append(np.frombuffer(part + bytes(langid.STRETCH - len(part)), np.uint8))
            lengths.append(len(part))
            owner.append(i)
    found = np.bincount(owner, langid.phrases(np.array(grid).T, np.array(lengths), steps), len(texts))
    assert found.tolist() == [brute_phrases(t, sample) for t in texts]


def test_automaton_accepts_the_substrings_only():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 3, 60)
    moves = langid.suffix_automaton(text, 3)
    inside = {tuple(text[a:b].tolist()) for a in range(60) for b in range(a + 1, 61)}
    for word in list(inside)[:400] + [tuple(rng.integers(0, 3, 7).tolist()) for _ in range(200)]:
        state = 0
        for s in word:
            state = moves[state, s] if state >= 0 else -1
        assert (state >= 0) == (word in inside)


def test_held_out_accuracy(spark):
    got = langid.op9_langid(spark, "/root/testdata/sf0.1")
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert len(rows) > 2000
    assert all(is_held_out(r.doc_id) for r in rows) and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.98


def test_odd_rows(spark):
    samples = {"en": "one two three four five six word last second line row without", "de": "zwei drei vier sechs wort zeile letzte"}
    docs = with_clashes(odd_docs(spark), "score", "lang_pred", "other")
    got = langid.identify(docs, samples)
    assert got.columns == [c for c in docs.columns if c not in ("score", "lang_pred")] + ["lang_pred", "score", "chars_per_phrase"]
    rows = {r.doc_id: r for r in got.collect()}
    assert [rows[i].lang_pred for i in (2, 3, 4, -9)] == ["und"] * 4 and rows[2].score == 0
    assert rows[1].lang_pred == "en" and got.count() == odd_docs(spark).count()
    assert got.schema == langid.identify(docs, samples).schema


def test_no_labels_and_empty(spark):
    docs = frame(spark, [(1, "some text", None, "s", 9)])
    assert langid.training_sample(docs) == {}
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, {}).collect()] == [("und", 0.0)]
    assert langid.training_sample(empty_docs(spark)) == {}
    assert langid.identify(empty_docs(spark), {"en": "a b c"}).count() == 0


def test_sample_leaves_held_out_rows_and_bounds(spark):
    rows = [(i, ("held " if is_held_out(i) else "seen ") * 50, "en", "s", 250) for i in range(300)]
    sample = langid.training_sample(frame(spark, rows), chars=1000)
    assert "held" not in sample["en"] and len(sample["en"]) == 1000


def test_recognised_keeps_clean_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    kept = langid.recognised(docs, langid.training_sample(docs))
    assert kept.columns == docs.columns
    assert kept.count() >= 0.99 * docs.filter("text rlike '\\\\p{L}'").count()


def words_of(rng, letters, n, words=60):
    known = ["".join(rng.choice(letters) for _ in range(5)) for _ in range(words)]
    return " ".join(rng.choice(known) for _ in range(n)), " ".join(rng.choice(known) for _ in range(40))


def test_every_letter_of_every_script_counts(spark):
    """Two languages in each rare script with words of one length: only the letters tell them apart."""
    rng = random.Random(4)
    scripts = {
        "latin": [chr(c) for c in (*range(97, 123), *range(0xE0, 0xF7))],
        "cyrillic": [chr(c) for c in range(0x430, 0x450)],
        "greek": [chr(c) for c in range(0x3B1, 0x3CA)],
        "han": [chr(c) for c in range(0x4E00, 0x5400)],
        "hangul": [chr(c) for c in range(0xAC00, 0xB000)],
    }
    samples, texts = {}, {}
    for name, letters in scripts.items():
        for i in (1, 2):
            n = 2000 if name in ("latin", "cyrillic") else 300
            samples[f"{name}{i}"], texts[f"{name}{i}"] = words_of(rng, letters, n)
    model = langid.fit(samples)
    assert langid.classify(list(texts.values()), model)[0] == list(texts)
    docs = frame(spark, [(i, t, None, "s", 0) for i, t in enumerate(texts.values())])
    assert langid.recognised(docs, samples).count() == len(texts)


def test_sparse_steps_parse_like_dense_ones(monkeypatch):
    rng = random.Random(6)
    samples = {x: words_of(rng, letters, 200)[0] for x, letters in (("a", "abcdef"), ("b", "abcxyz"), ("c", "αβγ"))}
    texts = [words_of(rng, letters, 900)[0] for letters in ("abcdef", "abcxyz", "abqα一 1")] + list(samples.values())
    want = langid.classify(texts, langid.fit(samples))
    monkeypatch.setattr(langid, "DENSE_BYTES", 0)
    model = langid.fit(samples)
    assert all(isinstance(s, langid.SparseSteps) for s in model["steps"])
    assert langid.classify(texts, model) == want


def test_every_label_is_learned(spark):
    rows = [(i, "some words of this language", f"l{i % 70:02d}", "s", 0) for i in range(420)]
    assert len(langid.training_sample(frame(spark, rows))) == 70


def test_letters_with_more_bits_have_shorter_phrases():
    rng = random.Random(2)
    han = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(20_000))
    least = langid.least_phrases({"zh": han, "en": "the quick brown fox jumps over the lazy dog", "none": "1"})
    assert set(least) == {"zh"} and 0.9 < least["zh"] < 1.2


def test_tiny_samples_do_not_win(spark):
    """A label with a two-letter sample gets none but its own texts."""
    rng = random.Random(12)
    rows, truth = [], {}
    letters = {"la": "abcdefgh", "lb": "fghijklm", "lc": "klmnopqr", "ld": "pqrstuva"}
    for i in range(240):
        lang = rng.choice(sorted(letters))
        text = " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randrange(2, 9))) for _ in range(60))
        rows.append((i, text, lang, None, 0))
        truth[i] = lang
    tiny = next(i for i in range(1000, 1100) if not is_held_out(i))
    plain = langid.training_sample(frame(spark, rows))
    extra = langid.training_sample(frame(spark, [*rows, (tiny, "hi", "xx", None, 0)]))
    assert extra["xx"] == "hi" and {k: v for k, v in extra.items() if k != "xx"} == plain
    for samples in (plain, extra):
        got = {r.doc_id: r.lang_pred for r in langid.identify(frame(spark, rows), samples).collect()}
        assert sum(got[i] == truth[i] for i in truth if is_held_out(i)) >= 0.97 * sum(map(is_held_out, truth))
