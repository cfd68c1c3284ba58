"""Registered queries: each SURVEY operator run over the driver tables, with its oracle SQL."""

from feedlens.plans import aspects, clusters, corpus, files, mapping, responses  # noqa: F401  (registration)
from feedlens.plans.registry import CHECK, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "CHECK"]
