"""Queries over the given tables, one or more per operator, with expected results in SQL."""

from feedloom.plans.catalogue import (  # noqa: F401
    enrich_queries,
    ingest_queries,
    run_queries,
    search_queries,
    store_queries,
)
from feedloom.plans.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
