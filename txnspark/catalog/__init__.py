"""Registered queries with their oracle SQL."""

from txnspark.catalog import checks, feeds, marts, model, relational, scalars  # noqa: F401  (registration)
from txnspark.catalog.registry import oracles, registered

__all__ = ["oracles", "registered"]
