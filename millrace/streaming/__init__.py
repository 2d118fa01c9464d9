import sys

from pyspark import cloudpickle

from millrace.streaming.batching import chunk_stream, measured_shards, session_counts_stream
from millrace.streaming.enrich import enrich_stream, expired_keys, start_enriching
from millrace.streaming.gate import count_gate_stream, expiring_gate_stream, gate_stream, running_count_stream
from millrace.streaming.ingest import ingest_totals, start_ingest
from millrace.streaming.jobs import commit_acks, run_available, start_batches, start_index

__all__ = [
    "chunk_stream",
    "commit_acks",
    "count_gate_stream",
    "enrich_stream",
    "expired_keys",
    "expiring_gate_stream",
    "gate_stream",
    "ingest_totals",
    "measured_shards",
    "run_available",
    "running_count_stream",
    "session_counts_stream",
    "start_batches",
    "start_enriching",
    "start_index",
    "start_ingest",
]

# Stateful processors travel to the executors with the query, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
