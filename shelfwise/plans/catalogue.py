"""Imports every query module so that the registry is complete."""

from shelfwise.plans.registry import REGISTRY
from shelfwise.plans import (  # noqa: F401
    queries_attributes,
    queries_catalog,
    queries_io,
    queries_links,
    queries_passages,
    queries_profile,
    queries_search,
    queries_selecting,
)

__all__ = ["REGISTRY"]
