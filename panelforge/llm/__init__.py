"""Operators for preparing text corpora (documents and web pages) at scale."""
