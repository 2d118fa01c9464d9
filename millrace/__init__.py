"""millrace: completeness gating and enrichment of multi-source records on Spark."""

from millrace.spec import Registry, RunConfig, SourceSpec

__all__ = ["Registry", "RunConfig", "SourceSpec"]
