"""All registered queries."""

from __future__ import annotations

from railstream.plans import (  # noqa: F401  (imported to register their queries)
    archive_queries,
    feed_queries,
    sample_queries,
    station_queries,
    stream_queries,
)
from railstream.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
