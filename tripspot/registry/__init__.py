"""The registered queries and their oracle SQL."""

from tripspot.registry.base import ORACLES, QUERIES
from tripspot.registry import scans, cleaning, joins, aggregates, models, streams  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
