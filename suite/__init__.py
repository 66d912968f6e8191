"""Every operator as a query over the driver's tables, with its SQL counterpart."""

from suite import encoding, flows, graphs, joins, lookups, models, scalars, selection, sets, sources, splits, stats
from suite.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
