"""The operators bound to the test tables, each with the SQL it is checked against."""

from millrace.plans import calendars, checks, live, models, records, tables_io  # noqa: F401
from millrace.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
