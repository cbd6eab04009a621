"""Cairn: a Spark-native engine that builds, maintains and queries a library corpus."""

__version__ = "0.1.0"
