"""All registered queries of the engine, with the SQL each is compared with."""

from __future__ import annotations

from .plans import catering, cleaning, deliveries, forecasting, loads, maintenance, registrations, streams, tracking  # noqa: F401  they register themselves
from .plans.base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
