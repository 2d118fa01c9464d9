from millrace.plans.catalog import ORACLES, QUERIES
from millrace.plans import gate_queries, ingest_queries, join_queries, store_queries, stream_queries  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
