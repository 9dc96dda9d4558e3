"""Disclosure filings as typed Spark tables: sources, parsing, enrichment, gates, sinks."""

__version__ = "0.1.0"
