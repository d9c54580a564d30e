"""Operators for large training-data pipelines (deduplication, extraction, search,
tokenization, decontamination, quality).  Nothing outside this subpackage imports it."""
