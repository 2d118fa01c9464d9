from millrace.sinks.store import Store
from millrace.sinks.text import ack_messages, json_lines, topic_messages, write_json_text, write_topic
from millrace.sinks.lookup import load_lookup

__all__ = [
    "Store",
    "ack_messages",
    "json_lines",
    "load_lookup",
    "topic_messages",
    "write_json_text",
    "write_topic",
]
