"""Operators for preparing text corpora: deduplication, search, scoring, packing, redaction."""
