"""All registered queries."""

from millrace.plans import (  # noqa: F401  (importing a module registers its queries)
    activity,
    checks,
    cleaned,
    files,
    groups,
    joined,
    layouts,
    ledgers,
    ordered,
    rows,
    streams,
)
from millrace.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
