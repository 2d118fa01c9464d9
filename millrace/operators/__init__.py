from millrace.operators.batching import assign_chunks, chunk_summary, session_counts, tumbling_window
from millrace.operators.enrich import Part, assemble, enrich_nway, lookup_join, part_acks, rejected_rows
from millrace.operators.gate import gate_count, gate_distinct, incomplete_keys, probe_cost, running_count
from millrace.operators.ingest import ingest_counts, surrogate_keys, take_rows
from millrace.operators.latest import latest_per_key, lookup_by_keys

__all__ = [
    "Part",
    "assemble",
    "assign_chunks",
    "chunk_summary",
    "enrich_nway",
    "gate_count",
    "gate_distinct",
    "incomplete_keys",
    "ingest_counts",
    "latest_per_key",
    "lookup_by_keys",
    "lookup_join",
    "part_acks",
    "probe_cost",
    "rejected_rows",
    "running_count",
    "session_counts",
    "surrogate_keys",
    "take_rows",
    "tumbling_window",
]
