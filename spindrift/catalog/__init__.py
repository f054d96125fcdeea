"""Queries over the benchmark tables, each beside the SQL that must give the same rows.

The queries shape the tables into the inputs of the jobs in :mod:`spindrift.plans` or call the
operators directly.
"""

from spindrift.catalog.base import QUERIES, SQL
from spindrift.catalog import banking, markets, operators, people, schedules, school  # noqa: F401

__all__ = ["QUERIES", "SQL"]
