"""Registered queries and their SQL counterparts, by area."""

from __future__ import annotations

from importlib import import_module

AREAS = ["daily", "retrieval", "quality", "drift", "learning", "streams", "states", "files"]


def all_queries() -> dict:
    merged: dict = {}
    for area in AREAS:
        merged.update(import_module(f"tallyglass.registered.{area}").QUERIES)
    return merged


def all_oracle_sql() -> dict:
    merged: dict = {}
    for area in AREAS:
        merged.update(import_module(f"tallyglass.registered.{area}").ORACLE)
    return merged
