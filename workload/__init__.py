"""The library at work on the benchmark tables, with the same questions as SQL for a second engine."""

from workload import column_queries, page_queries, relation_queries, storage_queries  # noqa: F401
from workload.registry import ORACLES as SQL
from workload.registry import QUERIES

__all__ = ["QUERIES", "SQL"]
