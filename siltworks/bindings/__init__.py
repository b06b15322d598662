"""Every operator as a query over the given tables, with the SQL it must agree with."""

from siltworks.bindings.base import ORACLE, QUERIES
from siltworks.bindings import (  # noqa: F401  (registering is their job)
    aggregates, calendars, checks, columns, comparison, expectations, joins, models, ordered, scalars, storage,
)

__all__ = ["ORACLE", "QUERIES"]
