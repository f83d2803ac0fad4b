"""Operators for training-data pipelines; nothing else in the library imports this package."""

from __future__ import annotations

from importlib import import_module

MODULES = ["warc", "packing", "topk", "rans", "pii", "fingerprint", "mixing", "linededup", "langid", "ngramjoin", "negatives", "decontaminate", "whitening"]


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for module in MODULES:
        merged.update(getattr(import_module(f"tallyglass.llm.{module}"), attribute))
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracle_sql() -> dict:
    return _merged("ORACLE")
