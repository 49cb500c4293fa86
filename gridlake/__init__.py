"""Layered time-series lake operators on Spark SQL and Structured Streaming."""

__version__ = "0.1.0"
