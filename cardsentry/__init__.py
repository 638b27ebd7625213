"""Spark-native risk analytics over card-transaction tables and streams."""

__version__ = "0.1.0"
