"""Operators for building training corpora: filtering, deduplication, mixing, packing, search and scoring.

Nothing else in the package imports this subpackage.
"""
