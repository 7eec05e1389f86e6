"""Spark-native engine for building, deduplicating, checking and querying a typed knowledge graph."""

__version__ = "0.1.0"
