"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

Language ID drops what is in no known language; line dedup removes repeated lines, and documents of which no
word is left; the n-gram join keeps one document of each group of near copies; mixing repeats documents to
the target weights of their sources; packing lays the token ids of what is left in windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.llm import langid, linededup, mixing, ngramjoin, packing
from tallyglass.llm.common import DOCUMENT_COLUMNS, table
from tallyglass.workspace import materialize, ship_package


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = docs.select(*DOCUMENT_COLUMNS)
    return langid.recognised(docs, langid.training_sample(docs))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup; a document that has lost lines and has no word left goes."""
    ship_package(spark)
    cleaned = linededup.dedup_lines(docs.select(*DOCUMENT_COLUMNS))
    kept = cleaned.filter((F.col("n_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    return kept.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*DOCUMENT_COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return ngramjoin.first_of_components(docs.select(*DOCUMENT_COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return mixing.mix(docs.select(*DOCUMENT_COLUMNS)).select(*DOCUMENT_COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pieces_digest(packing.pack(docs))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("near_copies", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
