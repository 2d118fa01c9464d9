"""Operators for training-data pipelines. Nothing outside this folder imports it, except the driver entry."""

from millrace.llm import queries  # noqa: F401
from millrace.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
