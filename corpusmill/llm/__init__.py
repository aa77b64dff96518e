"""Operators for preparing training text: scoring, mixing, de-duplication, scans and shards.

Nothing outside this folder imports it; `corpus_pipeline.py` chains five of its operators.
"""
