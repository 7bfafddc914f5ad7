"""Batch content analytics on Spark: raw text tables -> unified content -> ranked insights."""

__version__ = "0.1.0"
