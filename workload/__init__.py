"""Registered queries: each runs an operator over the captured tables, most with the same
question as SQL for cross-checking."""

from workload import aggregates, filters, joins, licenses, pages, scalars, sinks, sources, streams, windows
from workload import archives, crawls
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
