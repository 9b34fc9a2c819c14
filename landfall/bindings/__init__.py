"""The operators bound to the shared test tables, each next to equivalent SQL."""

from landfall.bindings import (  # noqa: F401
    aggregates,
    lookups,
    quality,
    star,
    storage,
    texts,
    windows,
)
from landfall.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
