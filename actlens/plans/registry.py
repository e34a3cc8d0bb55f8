"""All queries of the act-analytics part and their SQL."""

from __future__ import annotations

from actlens.plans import base_plans, flow_plans, search_plans, state_plans, text_plans, time_plans  # noqa: F401
from actlens.plans.base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
