"""Registered queries, by subject."""

from corpusmill.plans import chunking, pages, retrieval, stats, tables, texts  # noqa: F401
from corpusmill.plans.registry import ORACLES, QUERIES  # noqa: F401
