"""Spark-first analytics over corpora of nested descriptor records."""

__version__ = "0.1.0"
