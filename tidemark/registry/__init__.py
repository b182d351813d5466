"""Registry of all queries with their check texts."""

from tidemark.registry import aggregation, analysis, events, relational, storage, warehouse  # noqa: F401
from tidemark.registry.base import ORACLES, QUERIES  # noqa: F401
