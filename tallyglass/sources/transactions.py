"""Reading raw daily transaction files and their Parquet successors."""

from __future__ import annotations

from enum import Enum

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.operators.cleaning import with_day
from tallyglass.schema import TIME_COLUMN, TRANSACTION_SCHEMA
from tallyglass.sources.backlog import file_stem

CORRUPT = "_corrupt_record"
FILE_KEY = "file_key"
LOG_FOLDER = "_processed"


class LoadingMethod(Enum):
    FULL_DATASET = "full"
    ONE_BY_ONE = "by_day"


def read_transactions(
    spark: SparkSession, path: str | list[str], schema: T.StructType = TRANSACTION_SCHEMA, keep_corrupt: bool = False
) -> DataFrame:
    """Comma-separated text with a fixed schema; a file, a folder or a glob. All-null rows are dropped.

    Header and broken lines parse to nulls; ``keep_corrupt`` keeps their text beside them instead.
    """
    if keep_corrupt:
        wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
        return spark.read.schema(wide).option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    return spark.read.schema(schema).csv(path).dropna(how="all")


def load(spark: SparkSession, path: str, method: LoadingMethod = LoadingMethod.ONE_BY_ONE) -> DataFrame:
    """All files of a folder; by day adds a ``date`` column and removes rows without a time.

    A missing path raises. Days are a column, not a driver loop: group or partition by it.
    """
    rows = read_transactions(spark, path)
    if method is LoadingMethod.FULL_DATASET:
        return rows
    return with_day(rows).filter(F.col("date").isNotNull())


def read_with_file_key(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION_SCHEMA) -> DataFrame:
    """Rows with ``file_key``, the stem of their input file."""
    rows = spark.read.schema(schema).csv(path)
    return rows.withColumn(FILE_KEY, file_stem(F.col("_metadata.file_path"))).dropna(
        how="all", subset=schema.fieldNames()
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder: path, stem, bytes, modification time. File contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", file_stem(F.col("path")).alias("key"), "length", "modificationTime")


def processed_keys(spark: SparkSession, output: str) -> DataFrame:
    """Keys in the output's log of finished files; none when there is no output yet."""
    try:
        return spark.read.schema("key string").parquet(f"{output.rstrip('/')}/{LOG_FOLDER}").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "key string")


def mark_processed(spark: SparkSession, output: str, key: str) -> None:
    """Log a finished file, also one of which no row was kept. Readers of the output skip the log's folder."""
    row = spark.range(1).select(F.lit(key).alias("key")).coalesce(1)
    row.write.mode("append").parquet(f"{output.rstrip('/')}/{LOG_FOLDER}")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def from_pandas(spark: SparkSession, frame: pd.DataFrame, schema: T.StructType | None = None) -> DataFrame:
    return spark.createDataFrame(frame, schema) if schema else spark.createDataFrame(frame)


def parse_time(df: DataFrame, column: str = TIME_COLUMN) -> DataFrame:
    """Timestamp through text, unparsable values to null."""
    return df.withColumn(column, F.try_to_timestamp(F.col(column).cast("string")))


def to_pandas(df: DataFrame, limit: int, time_column: str = TIME_COLUMN) -> pd.DataFrame:
    """All rows as pandas, for inspection; an error if there are more than ``limit``. There is no unbounded form."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    bounded = df.limit(limit + 1)
    if time_column in df.columns:
        bounded = bounded.withColumn(time_column, F.col(time_column).cast("string"))
    frame = bounded.toPandas()
    if len(frame) > limit:
        raise ValueError(f"more than {limit} rows")
    if time_column in frame:
        frame[time_column] = pd.to_datetime(frame[time_column], errors="coerce", format="ISO8601")
    return frame


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)
