"""Operators for large text corpora; nothing outside this subpackage (and `corpus_pipeline.py`) imports it."""
