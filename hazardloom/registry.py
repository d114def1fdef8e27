"""All registered queries of the hazard engine."""

from hazardloom.queries import ORACLE, QUERIES, merging, places, serving, statistics, streams, texts

__all__ = ["ORACLE", "QUERIES", "merging", "places", "serving", "statistics", "streams", "texts"]
