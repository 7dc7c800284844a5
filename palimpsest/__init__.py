"""Palimpsest: wiki revision histories on PySpark - ingest, curation, analytics and data-quality operators."""

__version__ = "0.1.0"
