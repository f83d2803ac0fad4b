"""Table layouts and column lists shared by every operator."""

from pyspark.sql import types as T

# The raw daily transaction file.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.IntegerType(), True),
        T.StructField("tx_datetime", T.TimestampType(), True),
        T.StructField("customer_id", T.IntegerType(), True),
        T.StructField("terminal_id", T.IntegerType(), True),
        T.StructField("tx_amount", T.DoubleType(), True),
        T.StructField("tx_time_seconds", T.IntegerType(), True),
        T.StructField("tx_time_days", T.IntegerType(), True),
        T.StructField("tx_fraud", T.IntegerType(), True),
        T.StructField("tx_fraud_scenario", T.IntegerType(), True),
    ]
)
TIME_COLUMN = "tx_datetime"
NUMERIC_COLUMNS = [
    "transaction_id",
    "customer_id",
    "terminal_id",
    "tx_amount",
    "tx_time_seconds",
    "tx_time_days",
    "tx_fraud",
    "tx_fraud_scenario",
]
POSITIVE_COLUMNS = ["transaction_id", "customer_id", "terminal_id", "tx_amount"]
TARGET_COLUMNS = ["tx_fraud", "tx_fraud_scenario"]
LABEL = "tx_fraud"
MODEL_FEATURES = ["tx_amount"]


def wide_transaction_schema() -> T.StructType:
    """The same layout with 64-bit keys, for feeds that pass two billion transactions."""
    keys = {"transaction_id", "customer_id", "terminal_id"}
    return T.StructType(
        [
            T.StructField(f.name, T.LongType() if f.name in keys else f.dataType, True)
            for f in TRANSACTION_SCHEMA
        ]
    )
