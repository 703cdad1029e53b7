"""Spark-native operators for event registers and long entity-attribute-value series."""

__version__ = "0.1.0"
