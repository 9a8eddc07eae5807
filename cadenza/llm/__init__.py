"""Operators for large training-data corpora (documents, pages, benchmark)."""
