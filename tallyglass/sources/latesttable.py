"""Keyed latest-row table whose lookups open only the files that may hold their keys.

A load keeps the newest row per key, deals the rows over files by a hash of the key, and commits the load under the
next number (``commitlog``) once a manifest is written beside it: per file the row count and a Bloom filter, as bitmaps
of 32,768 bits, one per ``KEYS_PER_BITMAP`` keys. A lookup hashes the asked keys, finds by the manifests which files of
which loads may hold them, and reads those only; the newest row per key over them is the answer. A load that failed
before its commit is never seen; a retried one, with the same ``key``, adds nothing.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.operators.asof import latest_per_key
from tallyglass.sources.commitlog import CommitLog
from tallyglass.workspace import checked_broadcast, materialize

ROWS_PER_FILE = 1_000_000
KEYS_PER_BITMAP = 2048
BITS = 32_768
PROBES = 3


def _hash(keys: list[str], salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *keys)


def _bucket(keys: list[str], files: Column) -> Column:
    return F.pmod(_hash(keys, 1), files).cast("int")


def _bitmap(keys: list[str], bitmaps: Column) -> Column:
    return F.pmod(_hash(keys, 2), bitmaps).cast("int")


def _probe(keys: list[str], number: int) -> Column:
    return F.pmod(_hash(keys, 10 + number), F.lit(BITS)).cast("int")


def _has_bit(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2.0), place % 8)) % 2 == 1


@dataclass(frozen=True)
class LatestTable:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    timestamp: str = "event_timestamp"
    created: str | None = "created"

    def _log(self) -> CommitLog:
        return CommitLog(f"{self.path}/_log", self.spark)

    def load(self, rows: DataFrame, key: str | None = None, rows_per_file: int = ROWS_PER_FILE) -> int | None:
        """Add a load; None if a load of that ``key`` is there."""
        log, keys = self._log(), list(self.keys)
        if key is not None and any(e.get("key") == key for _, e in log.entries()):
            return None
        newest = materialize(latest_per_key(rows, keys, self.timestamp, self.created), "latest-load")
        count = newest.count()
        files = max(1, math.ceil(count / rows_per_file))
        bitmaps = max(1, math.ceil(count / files / KEYS_PER_BITMAP))
        folder = f"load-{uuid.uuid4().hex}"
        dealt = newest.withColumn("_bucket", _bucket(keys, F.lit(files)))
        dealt.repartition(files, "_bucket").sortWithinPartitions("_bucket", *keys).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}/rows")
        bits = dealt.select(
            "_bucket", _bitmap(keys, F.lit(bitmaps)).alias("_bitmap"), F.explode(F.array(*[_probe(keys, i) for i in range(PROBES)])).alias("_place")
        )
        manifest = bits.groupBy("_bucket", "_bitmap").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_place") + 1)).alias("_bits"))
        manifest.write.parquet(f"{self.path}/{folder}/manifest")

        def build(_: int) -> dict | None:
            if key is not None and any(e.get("key") == key for _, e in log.entries()):
                return None
            return {"folder": folder, "files": files, "bitmaps": bitmaps, "rows": count, "key": key, "schema": newest.schema.jsonValue()}

        return log.commit(build)

    def _loads(self) -> list[dict]:
        return [e for _, e in self._log().entries() if e["rows"]]

    def candidates(self, asked: DataFrame) -> list[str]:
        """Folders of the files that may hold any of the asked keys."""
        loads, keys = self._loads(), list(self.keys)
        if not loads:
            return []
        shapes = F.array(*[
            F.struct(F.lit(e["folder"]).alias("_folder"), F.lit(e["files"]).alias("_files"), F.lit(e["bitmaps"]).alias("_bitmaps")) for e in loads
        ])
        wanted = asked.select(*keys).distinct().withColumn("_load", F.explode(shapes)).select(*keys, "_load.*")
        wanted = wanted.withColumns({"_bucket": _bucket(keys, F.col("_files")), "_bitmap": _bitmap(keys, F.col("_bitmaps"))})
        manifests = None
        for e in loads:
            one = self.spark.read.schema("_bucket int, _bitmap int, _bits binary").parquet(f"{self.path}/{e['folder']}/manifest")
            one = one.withColumn("_folder", F.lit(e["folder"]))
            manifests = one if manifests is None else manifests.unionByName(one)
        maybe = wanted.join(manifests, ["_folder", "_bucket", "_bitmap"])
        for i in range(PROBES):
            maybe = maybe.filter(_has_bit(F.col("_bits"), _probe(keys, i)))
        found = maybe.select(F.concat_ws("/", "_folder", F.lit("rows"), F.concat(F.lit("_bucket="), F.col("_bucket")))).distinct()
        return sorted(r[0] for r in found.collect())  # at most one row per file

    def lookup(self, asked: DataFrame) -> DataFrame:
        """Newest row of each asked key that the table holds."""
        loads = self._loads()
        if not loads:
            raise ValueError(f"nothing was loaded into {self.path}")
        schema = T.StructType.fromJson(loads[-1]["schema"])
        folders = [f"{self.path}/{f}" for f in self.candidates(asked)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*folders)
        wanted = checked_broadcast(asked.select(*self.keys).distinct(), "asked-keys")
        return latest_per_key(rows.join(wanted, list(self.keys), "left_semi").select(*schema.names), list(self.keys), self.timestamp, self.created)
