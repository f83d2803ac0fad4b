"""Shared scratch folder: intermediate tables that outlive executors, and checked broadcasts.

Intermediate results go to the folder the cluster names in ``spark.checkpoint.dir``. A table
written there is durable, so a lost executor costs a re-read, never a recomputation of the
whole upstream plan.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}

# A broadcast side is at most this many (narrow) rows; beyond it the plain join is used, and
# adaptive execution splits its skewed partitions.
MAX_BROADCAST_ROWS = 50_000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only for local masters without a setting."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", "") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tallyglass-")
    return _local_roots[context.applicationId]


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tallyglass-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the application's own part of the shared folder."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has stored. Call it when no DataFrame that reads it is needed any more."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: one computation, cut lineage, true size."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(
    small: DataFrame, label: str, max_rows: int = MAX_BROADCAST_ROWS, stored: bool = False
) -> DataFrame:
    """Store a summary table, count it (Parquet footers only) and hint a broadcast if it is small.

    Over the bound the table comes back without a hint: Spark then joins by its measured size,
    and adaptive skew handling splits hot keys. ``stored`` says that the table was materialised before.
    """
    table = small if stored else materialize(small, label)
    return F.broadcast(table) if table.count() <= max_rows else table


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per application).

    Not needed when the job was submitted with ``--py-files`` or the package is installed on the nodes.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tallyglass-ship-")) / "tallyglass-package"
    context.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
    _shipped.add(context.applicationId)
