"""Small tables for the operators' tests: every awkward case the docstrings define, and random prose."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Null cells in every column, empty and blank texts, a very long one, repeated rows, wide characters."""
    rng = random.Random(3)
    long_text = "\n".join(prose(rng, 50) for _ in range(600))
    return [
        (1, "One two three four five six.", "en", "src0", 28),
        (2, None, "en", "src0", None),
        (3, "", None, "src1", 0),
        (4, " \n\t ", "en", None, 4),
        (None, "a row without id", None, None, None),
        (5, long_text, "en", "src1", len(long_text)),
        (6, "One two three four five six.", "de", "src2", 28),
        (6, "One two three four five six.", "de", "src2", 28),
        (7, "word", "de", "src0", 4),
        (8, "\U0001d504\U0001d505 é 漢字 ́x\r\nsecond  line\n\nlast", "fr", "src0", 20),
        (-9, "12345 67890 !!! ???", "fr", "src9", 19),
    ]


def odd_docs(spark):
    return frame(spark, odd_rows())


def with_clashes(df, *names: str):
    """Extra columns under names that an operator might use itself."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("kept"))
    return df


def empty_docs(spark):
    return frame(spark, [])


def near_copies(seed: int = 5, groups: int = 12, singles: int = 60) -> list[tuple]:
    """Groups of copies with few edits, chains of edits, documents that share a passage, and strangers."""
    rng = random.Random(seed)
    passage = prose(rng, 30)
    rows, doc = [], 0
    for g in range(groups):
        base = prose(rng, rng.choice([6, 20, 60, 200])).split(" ")
        for _ in range(rng.choice([2, 3, 9])):
            words = list(base)
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = "edit" + str(rng.randrange(1000))
            if g % 3 == 0:
                base = words
            rows.append((doc := doc + 1, " ".join(words), "en", "src0", 0))
    for _ in range(singles):
        text = prose(rng, rng.choice([1, 3, 5, 40, 120]))
        rows.append((doc := doc + 1, f"{text} {passage} {prose(rng, 20)}" if rng.random() < 0.3 else text, "en", "src1", 0))
    rng.shuffle(rows)
    return rows


def types_of(df) -> dict[str, T.DataType]:
    return dict(df.dtypes)
