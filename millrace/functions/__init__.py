from millrace.functions.jsonio import json_key, parse_typed, rows_to_json, drop_nested_key, part_json

__all__ = ["json_key", "parse_typed", "rows_to_json", "drop_nested_key", "part_json"]
