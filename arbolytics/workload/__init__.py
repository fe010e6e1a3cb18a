"""The registered queries over the given tables."""

from arbolytics.workload import queries_features, queries_graph, queries_streams, queries_tables  # noqa: F401
from arbolytics.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
