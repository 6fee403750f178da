"""All queries over the fixture tables, and the SQL that gives the same rows."""

from __future__ import annotations

from . import keyed, relational, schemas, stores, values  # noqa: F401  they register their queries
from .tables import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
