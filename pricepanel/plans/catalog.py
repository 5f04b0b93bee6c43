"""The query catalog: every registered query and its oracle SQL.

Importing the ``queries_*`` modules registers their queries.
"""

from __future__ import annotations

from pricepanel.plans import queries_core, queries_quality, queries_reports, queries_sources  # noqa: F401
from pricepanel.plans.queries_core import flagship
from pricepanel.plans.registry import ORACLE, QUERIES, QueryFn


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["flagship", "queries", "oracle_sql"]
