"""Spark-native operators for event-listing data (DataFrame in, DataFrame out)."""

__version__ = "0.1.0"
