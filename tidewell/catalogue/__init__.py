"""All queries over the given tables."""

from tidewell.catalogue import events, features, inventory, lakehouse, recommendations, scoring, streams  # noqa: F401
from tidewell.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
