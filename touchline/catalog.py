"""Registry of the library's own queries and their oracles."""

from __future__ import annotations

from touchline.queries import aggregates, audits, events, identity, joins, modeling, sources  # noqa: F401  they register themselves
from touchline.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
