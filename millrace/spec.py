"""What a job needs to know about its sources: names, schemas, keys and run settings."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceSpec:
    """One source of parts: its name, the typed schema of a part and how its dates are written."""

    name: str
    schema: T.StructType
    key: str = "pcn"
    date_format: str = "MM-dd-yyyy"

    @property
    def wire_schema(self) -> T.StructType:
        """On the wire every value is text, so parsing starts from an all-string schema."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.schema.fields])


class Registry:
    """The expected sources, in order. Two sources may share a schema; names must differ."""

    def __init__(self, specs: list[SourceSpec]):
        names = [s.name for s in specs]
        if len(set(names)) != len(names):
            raise ValueError(f"source names must be unique: {names}")
        self._specs = {s.name: s for s in specs}

    @classmethod
    def parse(cls, text: str, schemas: Mapping[str, T.StructType], **options) -> "Registry":
        """Read ``"source|schema~source|schema"`` against a catalogue of named schemas."""
        specs = []
        for entry in text.split("~"):
            name, _, schema = entry.partition("|")
            if not name or schema not in schemas:
                raise ValueError(f"bad source entry {entry!r}; known schemas: {sorted(schemas)}")
            specs.append(SourceSpec(name, schemas[schema], **options))
        return cls(specs)

    @property
    def names(self) -> list[str]:
        return list(self._specs)

    def __getitem__(self, name: str) -> SourceSpec:
        return self._specs[name]

    def __iter__(self) -> Iterator[SourceSpec]:
        return iter(self._specs.values())

    def __len__(self) -> int:
        return len(self._specs)


@dataclass(frozen=True)
class RunConfig:
    """Run settings. Values the caller gives always win over the defaults."""

    key: str = "pcn"
    commit_suffix: str = "_committed"
    chunk_rows: int = 50
    chunk_timeout: str = "20 seconds"
    lookup_key: str = "patientID"
    lookup_source: str = "billing_cost"
    extra: dict[str, str] = field(default_factory=dict)

    def override(self, **values) -> "RunConfig":
        known = {k: v for k, v in values.items() if k in self.__dataclass_fields__ and k != "extra"}
        extra = {k: v for k, v in values.items() if k not in known and k != "extra"}
        return replace(self, **known, extra={**self.extra, **values.get("extra", {}), **extra})

    def commit_topic(self, topic: str) -> str:
        return topic + self.commit_suffix
