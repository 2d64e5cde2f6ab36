"""Spark DataFrame operators for retrieval, answer evaluation and dialogue tables."""

__version__ = "0.1.0"
