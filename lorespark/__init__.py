"""Spark-native analytics over wiki-like corpora and their side tables."""

__version__ = "0.1.0"
