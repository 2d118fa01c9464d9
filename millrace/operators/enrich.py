"""Join the parts of complete keys, and a lookup table, into one nested record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsonio import drop_nested_key
from millrace.operators.gate import gate_distinct
from millrace.operators.latest import latest_per_key, newest_struct
from millrace.operators.skew import MAX_GROUP_ROWS, join_unique
from millrace.session import materialize


@dataclass
class Part:
    """Rows of one source: where the key is, what orders its versions, which fields a record gets.

    Sources kept in one table are told apart by ``where``; pass the same ``df`` object for them and
    the table is scanned once for all.
    """

    name: str
    df: DataFrame
    key: str
    version: Sequence[str]
    fields: Sequence[str] = field(default_factory=list)
    where: Column | None = None

    def __post_init__(self):
        self.fields = list(self.fields) or [c for c in self.df.columns if c != self.key]

    @property
    def mine(self) -> Column:
        usable = F.col(self.key).isNotNull() & F.col(self.version[0]).isNotNull()
        return usable if self.where is None else usable & self.where


def rejected_rows(part: Part) -> DataFrame:
    """Rows of a source that no record can use, with the reason."""
    reason = F.when(F.col(part.key).isNull(), "missing key").when(
        F.col(part.version[0]).isNull(), "missing version"
    )
    own = part.df if part.where is None else part.df.where(part.where)
    return own.withColumn("reason", reason).where(F.col("reason").isNotNull())


def _by_table(parts: Sequence[Part]) -> list[list[Part]]:
    tables: dict[tuple, list[Part]] = {}
    for p in parts:
        tables.setdefault((id(p.df), p.key), []).append(p)
    return list(tables.values())


def part_acks(parts: Sequence[Part]) -> DataFrame:
    """The arrivals of all parts as input for the gate: key, source, commit_ts."""
    slices = []
    for shared in _by_table(parts):
        hits = F.array_compact(
            F.array(
                *[
                    F.when(p.mine, F.struct(F.lit(p.name).alias("source"), F.col(p.version[0]).alias("commit_ts")))
                    for p in shared
                ]
            )
        )
        slices.append(shared[0].df.select(F.col(shared[0].key).alias("key"), F.inline(hits)))
    return reduce(lambda a, b: a.unionByName(b), slices)


def enrich_nway(
    parts: Sequence[Part],
    gate: DataFrame | None = None,
    as_of: str = "latest",
    key: str = "key",
    max_group_rows: int = MAX_GROUP_ROWS,
    stored: bool = False,
) -> DataFrame:
    """One record per complete key: the key and one struct per source, its newest version.

    Upsert, gate and N-way join are one aggregate over the union of the sources: one shuffle,
    reduced to a row per key in every input task before it.

    ``gate`` may give the complete keys (column ``key``); a part that cannot be found then stays
    null and is named in ``missing_parts``. Without it, keys present in all parts are complete.
    ``as_of="completion"`` ignores versions later than the moment the key became complete; ``stored`` then says
    that the parts are tables, cheap to read several times.
    """
    if as_of not in ("latest", "completion"):
        raise ValueError("as_of is 'latest' or 'completion'")
    if as_of == "completion":
        parts = _until_completion(parts, max_group_rows, stored)
    names = [p.name for p in parts]
    slices = [
        shared[0]
        .df.where(reduce(or_, [p.mine for p in shared]))
        .select(
            F.col(shared[0].key).alias(key),
            *[F.when(p.mine, newest_struct(p.version, p.fields)).alias(f"_{p.name}") for p in shared],
        )
        for shared in _by_table(parts)
    ]
    found = [F.max(f"_{n}").alias(f"_{n}") for n in names]
    if gate is None:
        complete = reduce(and_, [F.col(f"_{n}").isNotNull() for n in names])
    else:
        slices.append(gate.select(F.col("key").alias(key), F.lit(True).alias("_gated")))
        found.append(F.max("_gated").alias("_gated"))
        complete = F.col("_gated")
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slices)
    missing = F.array_compact(F.array(*[F.when(F.col(f"_{n}").isNull(), F.lit(n)) for n in names]))
    return (
        merged.groupBy(key)
        .agg(*found)
        .where(complete)
        .select(
            key,
            *[
                F.when(
                    F.col(f"_{p.name}").isNotNull(),
                    F.struct(*[F.col(f"_{p.name}")[f].alias(f) for f in p.fields]),
                ).alias(p.name)
                for p in parts
            ],
            missing.alias("missing_parts"),
        )
    )


def _until_completion(parts: Sequence[Part], max_group_rows: int, stored: bool) -> list[Part]:
    done = gate_distinct(part_acks(parts), [p.name for p in parts]).select(
        F.col("key").alias("_done_key"), F.col("completed_ts").alias("_done_ts")
    )
    done = materialize(done, "complete")
    early = []
    for shared in _by_table(parts):
        df = join_unique(shared[0].df, done, {shared[0].key: "_done_key"}, "inner", max_group_rows, stored=stored)
        for p in shared:
            in_time = F.col(p.version[0]) <= F.col("_done_ts")
            early.append(replace(p, df=df, where=in_time if p.where is None else in_time & p.where))
    order = [p.name for p in parts]
    return sorted(early, key=lambda p: order.index(p.name))


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    lookup_key: str,
    out: str,
    version: Sequence[str] = (),
    max_group_rows: int | None = MAX_GROUP_ROWS,
    unique: bool = False,
    **limits,
) -> DataFrame:
    """Add the matching lookup row as struct ``out``; null where there is none.

    ``on`` may be a path such as ``billing_cost.patientID``. Repeated lookup keys are resolved to
    one row: the newest by ``version``, or the greatest by value when there is no version;
    ``unique`` says that there are none, as in a table of ``load_lookup``. Limits are those of ``join_unique``.
    For a stream the lookup is resolved once, not again in every micro-batch.
    """
    one = lookup if unique else latest_per_key(lookup, [lookup_key], version)
    if df.isStreaming and not unique:
        one = lookup = materialize(one, "lookup")
    right = one.select(F.col(lookup_key).alias("_lookup_key"), F.struct(*lookup.columns).alias(out))
    return join_unique(
        df.withColumn("_on", F.col(on)),
        right,
        {"_on": "_lookup_key"},
        "left",
        max_group_rows,
        bound=lookup,
        **limits,
    ).drop("_on", "_lookup_key")


def assemble(
    df: DataFrame, key: str, record_fields: Mapping[str, str], key_name: str | None = None
) -> DataFrame:
    """The enriched record: the key once, at the top, and each part under its record field.

    Parts are placed by source name, so two sources may have the same schema.
    """
    key_name = key_name or key
    present = {s: f for s, f in record_fields.items() if s in df.columns}
    record = df.select(
        F.col(key).alias(key_name), *[F.col(s).alias(f) for s, f in present.items()]
    )
    return drop_nested_key(record, key_name)
