import random
import re

import pytest

from tallyglass.llm import linededup
from tests.llm.helpers import empty_docs, frame, odd_docs, odd_rows, prose, with_clashes


def token_set(line):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar(a, b):
    n = len(a & b)
    return 100 * n >= 75 * (len(a) + len(b) - n)


def brute(rows):
    """Text of each row after the removal of lines with an earlier similar one."""
    order = sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    seen, out = [], {}
    for doc, text in order:
        kept = []
        for line in text.split("\n"):
            tokens = token_set(line)
            if not (tokens and any(similar(tokens, s) for s in seen)):
                kept.append(line)
            if tokens:
                seen.append(tokens)
        out[doc, text] = "\n".join(kept)
    return out


def line_corpus(seed, docs=60):
    rng = random.Random(seed)
    passage = prose(rng, 60)
    pool = [prose(rng, rng.choice([1, 3, 5, 6, 12, 40])) for _ in range(30)]
    rows = []
    for i in range(docs):
        lines = []
        for _ in range(rng.randrange(1, 8)):
            words = rng.choice(pool).split() if rng.random() < 0.7 else prose(rng, 15).split()
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(["edit", "Edit", "other"])
            line = " ".join(words)
            lines.append(f"{line} {passage}" if rng.random() < 0.2 else line.upper() if rng.random() < 0.1 else line)
        rows.append((i, "\n".join(lines), "en", "s", 0))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("keys", [400_000, 0])
def test_equals_brute_force(spark, monkeypatch, seed, keys):
    monkeypatch.setattr(linededup, "MAX_BROADCAST_KEYS", keys)
    rows = line_corpus(seed)
    want = brute(rows)
    got = linededup.dedup_lines(frame(spark, rows)).collect()
    texts = {r[0]: r[1] for r in rows}
    assert {r.doc_id: r.text for r in got} == {d: want[d, t] for d, t in texts.items()}
    for r in got:
        assert r.n_lines == texts[r.doc_id].count("\n") + 1
        assert r.n_removed == r.n_lines - (r.text.count("\n") + 1 if r.n_removed < r.n_lines else 0)


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark), "pos", "w", "tokens", "n_lines", "_doc", "_removed")
    got = linededup.dedup_lines(docs)
    assert got.columns == [*[c for c in docs.columns if c != "n_lines"], "n_lines", "n_removed"]
    rows = got.collect()
    assert len(rows) == len(odd_rows()) and all(r._doc == "kept" and r._removed == "kept" for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[2][0].text is None and by_id[2][0].n_lines == 0
    assert by_id[3][0].text == "" and by_id[4][0].text == " \n\t "
    assert [r.text for r in by_id[6]] == ["", ""] and by_id[1][0].n_removed == 0
    assert by_id[5][0].n_removed == 0


def test_empty_table(spark):
    assert linededup.dedup_lines(empty_docs(spark)).count() == 0


def test_a_hot_group_of_near_copies_meets_its_first_line_only(spark, monkeypatch):
    """Pairs that are verified grow with the members of a group, not with their square."""
    counted = []
    real = linededup.verified

    def watched(pairs, sets):
        counted.append(pairs.count())
        return real(pairs, sets)

    monkeypatch.setattr(linededup, "verified", watched)
    rng = random.Random(4)
    base = prose(rng, 60).split()
    rows = []
    for i in range(200):
        words = list(base)
        words[50 + i % 8] = f"edit{i}"
        rows.append((i, " ".join(words), "en", "s", 0))
    got = linededup.dedup_lines(frame(spark, rows)).filter("text <> ''").count()
    assert got == 1 and sum(counted) < 1000


def test_levels_put_frequent_tokens_last(spark):
    rng = random.Random(1)
    rows = [(i, f"{prose(rng, 12)} a b c d e f", "en", "s", 0) for i in range(300)]
    lines = linededup.lines_of(frame(spark, rows))
    levels = linededup.rarity_levels(lines)
    assert len(levels) == linededup.COUNTERS and max(levels) > 0
    last = {r.tokens[-1] for r in linededup.with_tokens(lines, levels).collect()}
    assert len(last) <= 2


def test_no_python_on_the_main_path(spark, sf_dir):
    plan = linededup.op8_linededup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_lines_that_share_a_passage_only_do_not_meet(spark, monkeypatch):
    """Coarse counters leave the passage in the prefixes; exact frequencies among the classes that are left do not."""
    counted = []
    real = linededup.verified

    def watched(pairs, sets):
        counted.append(pairs.count())
        return real(pairs, sets)

    monkeypatch.setattr(linededup, "verified", watched)
    monkeypatch.setattr(linededup, "COUNTERS", 4)
    rng = random.Random(5)
    passage, rows = prose(rng, 30), [(900, prose(rng, 30), "en", "s", 0), (901, "", "en", "s", 0)]
    rows[1] = (901, rows[0][1] + " end", "en", "s", 0)
    rows += [(i, f"{prose(rng, 11)} {passage} {prose(rng, 11)}", "en", "s", 0) for i in range(200)]
    got = linededup.dedup_lines(frame(spark, rows)).collect()
    assert [r.doc_id for r in got if r.n_removed] == [901] and sum(counted) < 1000


def test_classes_need_no_words(spark, monkeypatch):
    """Every line is split into words where levels and prefixes are made; classes come from the lines as texts."""
    split = []
    real = linededup.with_words
    monkeypatch.setattr(linededup, "with_words", lambda lines: split.append(set(lines.columns)) or real(lines))
    rows = [(1, "One  two\tthree\n\x0b ", "en", "s", 0), (2, " one two THREE ", "en", "s", 0), (3, "one two three four", "en", "s", 0)]
    got = {r.doc_id: (r.text, r.n_removed) for r in linededup.dedup_lines(frame(spark, rows)).collect()}
    assert got == {1: ("One  two\tthree\n\x0b ", 0), 2: ("", 1), 3: ("one two three four", 0)}
    assert len(split) == 3 and [("c" in s) for s in split] == [False, True, True]
    plan = linededup.lines_of(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "size(array_remove" not in plan  # a filter by it splits every line once more


def test_texts_are_lowered_once_and_little_pruning_is_not_repeated(spark, monkeypatch):
    """Lines come from the lowered text; a round that drops less than half of the rows is the last of its kind."""
    rows = [(1, "ΟΔΟΣ\nΣ ΑΣ\r\n\t\x0b\n A  b\x0cC \n\nİ end", "el", "s", 0), (2, None, "el", "s", 0)]
    lines = linededup.plain_lines(frame(spark, rows))
    want = {i: " ".join(re.split("[ \t\x0b\f\r]+", x.lower().strip(" \t\x0b\f\r"))) for i, x in enumerate(rows[0][1].split("\n"))}
    assert {r.pos: r.line for r in lines.collect()} == {i: x for i, x in want.items() if x}
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "lower(line" not in plan and "translate(line" not in plan

    stored = []
    real = linededup.materialize
    monkeypatch.setattr(linededup, "materialize", lambda df, label: stored.append(label) or real(df, label))
    rng = random.Random(7)
    rows = []
    for i in range(40):
        words = prose(rng, 30)
        rows += [(2 * i, words, "en", "s", 0), (2 * i + 1, f"{words} end", "en", "s", 0)]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(frame(spark, rows)).collect()}
    assert got == {r[0]: r[1] if r[0] % 2 == 0 else "" for r in rows}
    assert stored.count("line-postings") == 2 and stored.count("line-shared") == 1


def test_levels_split_each_line_once(spark):
    rows = [(1, "one two three four five six\nseven eight"), (2, "One  two three four five six"), (3, " \n"), (4, None)]
    lines = linededup.lines_of(spark.createDataFrame(rows, "doc_id bigint, text string"))
    slots = linededup.token_slots(lines)
    plan = slots._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 2  # the text and the line
    tokens = linededup.with_tokens(lines, [0] * linededup.COUNTERS)
    assert slots.count() == sum(max(1, len(r.w) - 4) for r in lines.collect()) == 5
    assert sorted(len(r.tokens) for r in tokens.collect()) == [1, 2, 2]
