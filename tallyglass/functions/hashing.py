"""Deterministic randomness: the same key gives the same draw on every engine and every retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def hash32(text: Column) -> Column:
    """First 32 bits of the MD5 of ``text`` as a non-negative bigint."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def pseudonym(column: Column, salt: str) -> Column:
    """Salted SHA-256 of an identifier; equal ids stay equal, so joins on pseudonyms still work."""
    return F.sha2(F.concat(F.lit(salt), column.cast("string")), 256)
