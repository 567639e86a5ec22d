"""Every operator as a query over the test tables, with its SQL twin."""

from __future__ import annotations

from gleaner.catalog.base import ORACLES, QUERIES
from gleaner.catalog import (  # noqa: F401  (importing registers the queries)
    layout,
    filters,
    pages,
    urlpii,
    dedup,
    substring,
    quality,
    segments,
    stats,
    pipelines,
)

__all__ = ["ORACLES", "QUERIES"]
