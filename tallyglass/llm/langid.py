"""Language identification by cross-parsing.

A suffix automaton of labelled text per language recognises every substring of that text. Parsing a document
against it takes the longest match again and again; each match is a phrase. The language whose text needs the
fewest phrases, times the bits of a pointer into that text, per character, is the nearest one. A letter that the text
lacks is a phrase of its own and costs at least the bits of a letter, so that a tiny text is not a cheap one.

The automata are fitted on a bounded sample: ``SAMPLE_CHARS`` characters for each language that occurs as a
label, from labelled rows in the order of a digest of their id, and at most ``SAMPLE_ROWS`` of them. Each language has its own letter table: every
letter of its sample, and one class for letters it lacks. Transitions are a dense array while all languages' arrays
together stay within ``DENSE_BYTES`` (narrowest first), else sorted keys; both parse alike. Everything else is done
for whole texts of all rows: a text is cut into stretches of ``STRETCH`` characters, each parsed from the
automaton's root, and all stretches of a slice step through one language's transitions together.

A text that is null or has no letter is ``und`` with score 0. Rows that repeat an id are treated alike. A
table without labelled rows, or an empty one, gives ``und`` for every row. Further columns stay where they
are in ``identify``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyglass.llm.common import DOCUMENT_COLUMNS, bounded_batches, kept, releasing, slices, table
from tallyglass.workspace import checked_broadcast

SAMPLE_CHARS = 60_000
SAMPLE_ROWS = 4_000
DENSE_BYTES = 1 << 28
STRETCH = 1024
SLICE = 1_000_000
UNKNOWN = "und"
# A text of at least LEAST_CHARS whose best language has shorter phrases than this is in no known language.
# Where a letter carries more than LETTER_BITS (syllables, ideographs), phrases are shorter in that proportion.
LEAST_PHRASE = 2.2
LETTER_BITS = 5.0
LEAST_CHARS = 40
END = 1 << 28


def held_out(doc_id: str = "doc_id"):
    """The rows that are never learned from: CRC-32 of the id as text leaves 1 over 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Labelled text per language, at least ``chars`` long where there is as much; see the module's bounds.

    The share of rows to look at follows from each language's number of characters, so the rows that are
    ranked per language are few whatever the size of the table.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & ~held_out())
    sizes = (
        rows.groupBy("lang")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("size"))
    )
    order = F.xxhash64(F.col("doc_id"), F.xxhash64("text"))
    share = F.least(F.lit(1.0), F.greatest(F.lit(3.0 * chars) / F.col("size"), F.lit(200.0) / F.col("n")))
    near = rows.join(checked_broadcast(sizes, "langid-sizes"), "lang").filter(
        (order.cast("double") / F.lit(float(1 << 63)) + 1.0) / 2.0 <= share
    )
    ranked = Window.partitionBy("lang").orderBy(order, "doc_id")
    before = F.coalesce(F.sum(F.char_length("text")).over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    picked = (
        near.select("lang", "text", "doc_id", before.alias("before"), F.row_number().over(ranked).alias("rank"))
        .filter((F.col("before") < chars) & (F.col("rank") <= SAMPLE_ROWS))
        .select("lang", "rank", F.substring("text", 1, 2 * chars).alias("text"))
        .collect()
    )
    out: dict[str, list[str]] = {}
    for row in sorted(picked, key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(row["lang"], []).append(row["text"])
    return {lang: " ".join(texts)[:chars] for lang, texts in out.items()}


def letters_of(text: str) -> set[str]:
    """The letters of a text in lower case, each character for itself."""
    return {c.lower()[:1] for c in set(text) if c.isalpha()}


def alphabet(samples: dict[str, str]):
    """Class of every code point: 0 for what is no letter, one for each letter of any sample, one for all others.

    Also, per language, its own class for each of these: 0, one for each letter of its sample, one for the rest.
    """
    import numpy as np

    own = {lang: letters_of(text) for lang, text in samples.items()}
    every = sorted(set().union(*own.values()))
    number = {c: i + 1 for i, c in enumerate(every)}
    other = len(every) + 1
    codes = np.zeros(0x110000, np.min_scalar_type(other))
    for point in range(0x110000):
        if 0xD800 <= point < 0xE000:
            continue
        char = chr(point)
        if char.isalpha():
            codes[point] = number.get(char.lower()[:1], other)
    local = {}
    for lang, found in own.items():
        local[lang] = np.full(other + 1, len(found) + 1, np.int32)
        local[lang][0] = 0
        for i, c in enumerate(sorted(found)):
            local[lang][number[c]] = i + 1
    return codes, local


def coded(text: str, codes):
    """Letter classes of a text; runs of other characters become one 0."""
    import numpy as np

    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    out = codes[points]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def automaton_moves(symbols) -> list[dict[int, int]]:
    """The smallest automaton of all substrings: per state the next state by class."""
    n = len(symbols)
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols.tolist():
        current = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and s not in moves[p]:
            moves[p][s] = current
            p = link[p]
        if p != -1:
            q = moves[p][s]
            if length[p] + 1 == length[q]:
                link[current] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(s) == q:
                    moves[p][s] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    assert len(moves) <= 2 * n + 1
    return moves


def dense(moves: list[dict[int, int]], classes: int):
    """Next state per state and class, -1 for none."""
    import numpy as np

    out = np.full((len(moves), classes), -1, np.int32)
    for state, move in enumerate(moves):
        for s, target in move.items():
            out[state, s] = target
    return out


def suffix_automaton(symbols, classes: int):
    """Transitions of the smallest automaton of all substrings, as an array."""
    return dense(automaton_moves(symbols), classes)


def phrase_steps(moves):
    """One array that a parse steps through: the next state, and from bit 28 on how many phrases ended.

    A symbol that the text does not have is a phrase of its own: it ends the phrase before it and itself.
    """
    import numpy as np

    known = moves[0] >= 0
    fresh = np.where(known, moves[0] + END, 2 * END)
    steps = np.where(moves >= 0, moves, fresh[None, :])
    steps[0] = np.where(known, moves[0], END)
    return np.ascontiguousarray(steps.astype(np.int32))


class DenseSteps:
    """The array of ``phrase_steps``."""

    def __init__(self, steps):
        self.flat, self.classes = steps.reshape(-1), steps.shape[1]

    def take(self, state, symbols):
        return self.flat[state * self.classes + symbols]


class SparseSteps:
    """The same steps from the transitions that exist, found among sorted keys of state and class."""

    def __init__(self, moves: list[dict[int, int]], classes: int):
        import numpy as np

        states = np.repeat(np.arange(len(moves), dtype=np.int64), [len(m) for m in moves])
        symbols = np.fromiter((s for m in moves for s in m), np.int64, len(states))
        targets = np.fromiter((t for m in moves for t in m.values()), np.int32, len(states))
        order = np.argsort(states * classes + symbols)
        self.keys, self.targets, self.classes = (states * classes + symbols)[order], targets[order], classes
        self.fresh = np.full(classes, 2 * END, np.int32)
        for s, target in moves[0].items():
            self.fresh[s] = target + END

    def take(self, state, symbols):
        import numpy as np

        if not len(self.keys):
            return self.fresh[symbols] - np.where(state == 0, np.int32(END), np.int32(0))
        key = state.astype(np.int64) * self.classes + symbols
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        # What the root lacks ends itself only; no phrase is open there.
        missed = self.fresh[symbols] - np.where(state == 0, np.int32(END), np.int32(0))
        return np.where(self.keys[place] == key, self.targets[place], missed)


def fit(samples: dict[str, str]) -> dict:
    """Languages, letter classes, and per language its own classes, the steps and the bits of a pointer."""
    import math

    import numpy as np

    codes, local = alphabet(samples)
    languages = sorted(samples)
    steps, bits, lacks, room = {}, {}, {}, DENSE_BYTES
    for lang in sorted(languages, key=lambda x: (int(local[x].max()), x)):
        classes = int(local[lang].max()) + 1
        symbols = local[lang][coded(samples[lang], codes)]
        moves = automaton_moves(symbols)
        size = 4 * len(moves) * classes
        if size <= room:
            room -= size
            steps[lang] = DenseSteps(phrase_steps(dense(moves, classes)))
        else:
            steps[lang] = SparseSteps(moves, classes)
        bits[lang] = math.log2(max(2, len(symbols)))
        lacks[lang] = np.ones(len(local[lang]), bool)
        lacks[lang][np.isin(local[lang], symbols)] = False
    return {
        "codes": codes,
        "languages": languages,
        "local": [local[x] for x in languages],
        "steps": [steps[x] for x in languages],
        "bits": [bits[x] for x in languages],
        "lacks": [lacks[x] for x in languages],
        "letter_bits": math.log2(max(2, int(codes.max()) + 1)),
    }


def phrases(stretches, lengths, steps, local=None):
    """Phrases of each stretch (columns of ``stretches``, classes by position), all parsed in step.

    ``local`` turns the classes into those of ``steps``.
    """
    import numpy as np

    if isinstance(steps, np.ndarray):
        steps = DenseSteps(steps)
    order = np.argsort(-lengths, kind="stable")
    alive = np.searchsorted(-lengths[order], -np.arange(stretches.shape[0]), side="left")
    columns = np.ascontiguousarray(stretches[:, order])
    columns = columns.astype(np.int32) if local is None else local[columns]
    state = np.zeros(len(order), np.int32)
    ends = np.zeros(len(order), np.int32)
    for t in range(stretches.shape[0]):
        m = alive[t]
        if not m:
            break
        step = steps.take(state[:m], columns[t, :m])
        ends[:m] += step >> 28
        state[:m] = step & (END - 1)
    out = np.empty(len(order), np.int64)
    out[order] = ends + (state > 0)
    return out


def classify(texts: list[str | None], model: dict) -> tuple[list[str], list[float], list[float]]:
    """Language, score and characters per phrase of each text.

    The score is how much cheaper the best language is than the second, from 0 to 1; 1 with one language.
    """
    import numpy as np

    rows = [coded(t or "", model["codes"]) for t in texts]
    letters = [bool(r.any()) for r in rows]
    if not model["languages"] or not any(letters):
        return [UNKNOWN] * len(rows), [0.0] * len(rows), [0.0] * len(rows)
    counts = np.array([-(-len(r) // STRETCH) for r in rows])
    owner = np.repeat(np.arange(len(rows)), counts)
    grid = np.zeros((int(counts.sum()), STRETCH), model["codes"].dtype)
    lengths = np.zeros(len(grid), np.int64)
    at = 0
    for r, n in zip(rows, counts.tolist()):
        grid[at : at + n].reshape(-1)[: len(r)] = r
        lengths[at : at + n] = STRETCH
        if n:
            lengths[at + n - 1] = len(r) - (n - 1) * STRETCH
        at += n
    columns = grid.T
    sizes = np.maximum(1, np.array([len(r) for r in rows]))
    parsed = (phrases(columns, lengths, s, local) for s, local in zip(model["steps"], model["local"]))
    found = np.array([np.bincount(owner, p, len(rows)) for p in parsed])
    # A letter that a sample lacks is spelled out, so a short sample does not make it cheap.
    symbols, place = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    spelled = np.array([np.bincount(place, lacks[symbols], len(rows)) for lacks in model["lacks"]])
    bits = np.array(model["bits"])[:, None]
    cost = (found * bits + spelled * np.maximum(0.0, model["letter_bits"] - bits)) / sizes
    best = np.argmin(cost, axis=0)
    least = cost[best, np.arange(len(rows))]
    second = np.partition(cost, 1, axis=0)[1] if len(cost) > 1 else np.full(len(rows), np.inf)
    score = np.clip(1.0 - least / second, 0.0, 1.0)
    phrase = sizes / np.maximum(1, found[best, np.arange(len(rows))])
    names = [model["languages"][b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters)]
    return names, [float(s) if ok else 0.0 for s, ok in zip(score, letters)], [float(p) if ok else 0.0 for p, ok in zip(phrase, letters)]


def identify(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``chars_per_phrase``; the model comes from ``samples``.

    Only the samples are broadcast (their size is bounded per language); each Python worker builds the automata once.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    key = hash(tuple(sorted(samples.items())))
    added = [n for n in ("lang_pred", "score", "chars_per_phrase") if n in docs.columns]
    docs = docs.drop(*added)
    schema = StructType([*docs.schema.fields])
    schema = schema.add("lang_pred", "string").add("score", "double").add("chars_per_phrase", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(("langid", key), lambda: fit(shared.value))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(batch, [len(t or "") for t in texts], SLICE):
                names, scores, lengths = classify(texts[a:b], model)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns, pa.array(names), pa.array(scores, pa.float64()), pa.array(lengths, pa.float64())],
                    [*batch.schema.names, "lang_pred", "score", "chars_per_phrase"],
                )

    return docs.mapInArrow(lambda batches: releasing(run(batches)), schema)


def least_phrases(samples: dict[str, str]) -> dict[str, float]:
    """Shortest phrases of real text per language, where its letters carry more than ``LETTER_BITS`` each."""
    import math
    from collections import Counter

    out = {}
    for lang, text in samples.items():
        seen = Counter(c.lower()[:1] for c in text if c.isalpha())
        total = seen.total()
        bits = -sum(n / total * math.log2(n / total) for n in seen.values())
        if bits > LETTER_BITS:
            out[lang] = LEAST_PHRASE * LETTER_BITS / bits
    return out


def recognised(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """The documents in a known language: not ``und``, and phrases as long as those of real text."""
    least = F.lit(LEAST_PHRASE)
    if short := least_phrases(samples):
        table_of = F.create_map(*[F.lit(x) for pair in sorted(short.items()) for x in pair])
        least = F.coalesce(table_of[F.col("lang_pred")], least)
    readable = (F.col("chars_per_phrase") >= least) | (F.char_length("text") < LEAST_CHARS)
    return identify(docs, samples).filter((F.col("lang_pred") != UNKNOWN) & readable).select(*docs.columns)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), training_sample(docs.select(*DOCUMENT_COLUMNS)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "chars_per_phrase")


QUERIES = {"op9_langid": op9_langid}
ORACLE: dict[str, str] = {}
