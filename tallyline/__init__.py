"""Ledger analytics as Spark jobs: batch, reports, quality checks and streams."""

__version__ = "0.1.0"
