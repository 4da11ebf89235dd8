"""Spark-native curation and analytics of robot-trajectory data."""

__version__ = "0.1.0"
