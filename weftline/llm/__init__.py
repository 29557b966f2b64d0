"""Operators for preparing training text: quality, deduplication, decontamination, packing, archives.

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.
"""
