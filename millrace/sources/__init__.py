from millrace.sources.delimited import good_rows, quarantined_rows, read_delimited, split_delimited
from millrace.sources.streams import read_file_streams, read_topics, topic_acks, union_sources

__all__ = [
    "good_rows",
    "quarantined_rows",
    "read_delimited",
    "split_delimited",
    "topic_acks",
    "read_file_streams",
    "read_topics",
    "union_sources",
]
