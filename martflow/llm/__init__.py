"""Operators of a large-scale training-data pipeline over the document and page tables."""
