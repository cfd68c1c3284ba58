"""Operators of a training-data pipeline (fingerprints, decontamination, dedup, sharding, scoring, packing ...).

Nothing else in ``feedlens`` imports this subpackage; its queries are in ``feedlens.llm.queries``.
"""
