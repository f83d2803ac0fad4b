"""Spark-native transaction analytics: cleaning, profiling, drift, model comparison, features."""

__version__ = "0.1.0"
