"""The whole way: delimited files to messages, messages to the store, stored parts to records.

Three jobs that run apart and may stop and restart at any time::

    publish            files -> JSON messages, malformed lines kept apart
    start_indexing     messages -> store and commit log
    start_converging   committed documents -> gate, join, lookup -> enriched JSON lines
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.jsonio import dated_text, json_key, parse_typed, rows_to_json
from millrace.operators.enrich import assemble, lookup_join
from millrace.operators.ingest import ingest_counts, surrogate_keys, take_rows
from millrace.operators.skew import ordered_position
from millrace.session import materialize, use_rocksdb
from millrace.sinks.lookup import read_lookup
from millrace.sinks.store import Store
from millrace.sources.delimited import BAD, LINE, good_rows, quarantined_rows, read_delimited
from millrace.spec import Registry, RunConfig
from millrace.streaming.enrich import start_enriching
from millrace.streaming.jobs import start_index, write_batch

POSITION = ["_file", "_block", "_row"]


def publish(
    spark: SparkSession,
    files: Mapping[str, str],
    out: str,
    rows: int | None = None,
    config: RunConfig = RunConfig(),
    seed: str = "42",
    key: str | None = None,
) -> DataFrame:
    """Turn each source's file into messages below ``out/messages/source=...`` and its malformed
    lines into ``out/malformed/source=...``. Returns the counts per source.

    Each source gets dense keys in its own random order, so the sources are mutually out of order.
    ``rows`` limits the data lines per source; malformed lines use up that budget. With ``key`` the files
    have keys of their own, in the column of that name, and none are made up.
    """
    counts = []
    for source, path in files.items():
        lines = read_delimited(spark, path, positions=True).withColumn("source", F.lit(source))
        fields = [c for c in lines.columns if c not in (*POSITION, BAD, LINE, "source")]
        if rows is not None:
            lines = take_rows(lines, rows, POSITION)
        if key is not None:
            if key not in fields:
                raise ValueError(f"{path} has no column {key}")
            keyed = materialize(lines, "keyed")
            members = [f for f in fields if f != key]
        elif config.key in fields:
            raise ValueError(f"{path} has a column {config.key}: give key={config.key!r} to use it")
        else:
            # Numbered by line, so keys depend neither on how files are split nor on the folder they are in.
            lines = ordered_position(materialize(lines, "lines"), ["_file"], ["_block", "_row"], "_number")
            lines = lines.withColumn("_name", F.element_at(F.split("_file", "/"), -1))
            keyed = materialize(surrogate_keys(lines, ["_name", "_number", "_file"], name=config.key, seed=seed, mix=2), "keyed")
            members = fields
        own = F.col(f"`{key or config.key}`")
        messages = rows_to_json(good_rows(keyed), members, key=own, key_name=config.key)
        messages.write.mode("overwrite").text(f"{out}/messages/source={source}")
        quarantined_rows(keyed).write.mode("overwrite").text(f"{out}/malformed/source={source}")
        counts.append(ingest_counts(keyed))
    total = counts[0]
    for c in counts[1:]:
        total = total.unionByName(c)
    return total


def message_files(spark: SparkSession, out: str, **options: str) -> DataFrame:
    """Published messages as a stream: source, value, arrived, offset (where the file block begins)."""
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("source", T.StringType())])
    return (
        spark.readStream.schema(schema)
        .options(**options)
        .text(f"{out}/messages")
        .select(
            "source",
            "value",
            F.col("_metadata.file_modification_time").alias("arrived"),
            F.col("_metadata.file_block_start").alias("offset"),
        )
    )


def documents(messages: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """Messages with their key and a version that sorts by arrival; works for topics and files.

    Lines of one file block are read in order by one task, so row ids settle what the offset leaves open.
    """
    order = [F.unix_micros("arrived"), F.col("offset"), F.monotonically_increasing_id()]
    return messages.select(
        "source",
        json_key(F.col("value"), config.key).alias("key"),
        F.format_string("%020d-%020d-%020d", *order).alias("version"),
        "value",
    )


def document_store(root: str, sources: Sequence[str] | None = None) -> Store:
    return Store(root, "key", ["version"], sources)


def start_indexing(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    config: RunConfig = RunConfig(),
    once: bool = False,
    sources: Sequence[str] | None = None,
    refresh_every: int = 10,
) -> StreamingQuery:
    """Store messages and acknowledge them. Messages without a readable key are kept as failed, and those of
    other sources than ``sources``, if these are given. Every ``refresh_every`` micro-batches the store's current documents are
    brought up to date; 0 leaves that to another job."""
    store = document_store(root, sources)
    # Lines can be numbered within a micro-batch only, not on the stream.
    return start_index(
        messages, store, checkpoint, once, config.chunk_timeout, lambda batch: documents(batch, config), refresh_every=refresh_every
    )


def records(
    joined: DataFrame,
    registry: Registry,
    lookup: DataFrame,
    record_fields: Mapping[str, str],
    config: RunConfig = RunConfig(),
    lookup_name: str = "patient_info",
    strict: bool = False,
    text_dates: bool = False,
    unique_lookup: bool = False,
) -> DataFrame:
    """Joined JSON parts to typed, nested records with their lookup.

    With ``text_dates`` the dates of a part are text in the format of its source, as they came.
    """
    typed = joined
    for spec in registry:
        typed = parse_typed(typed, spec, spec.name, out="_part", errors="_bad_fields", strict=strict)
        typed = typed.drop(spec.name, "_bad_fields").withColumnRenamed("_part", spec.name)
    found = lookup_join(
        typed,
        lookup,
        f"{config.lookup_source}.{config.lookup_key}",
        config.lookup_key,
        lookup_name,
        unique=unique_lookup,
    )
    if text_dates:
        for spec in registry:
            found = found.withColumn(spec.name, dated_text(F.col(spec.name), spec))
    return assemble(found, "key", record_fields, key_name=config.key)


def start_converging(
    spark: SparkSession,
    root: str,
    registry: Registry,
    lookup: DataFrame | str,
    record_fields: Mapping[str, str],
    out: str,
    checkpoint: str,
    config: RunConfig = RunConfig(),
    once: bool = False,
    wait: str | None = None,
    delay: str = "0 seconds",
    memory: str = "7 days",
) -> StreamingQuery:
    """Write one enriched JSON line per key to ``out/records``, once all sources have committed a
    part for it: the commit log is the gate's input, and the parts are fetched from the store when a key is complete.
    ``lookup`` is a table, or the path of a loaded one: then every micro-batch joins the version
    that is newest when it begins. The records are first written to ``out/emitted`` with their keys.

    The state holds no parts. With ``wait`` it holds no key for ever either: keys that stay incomplete for so long after their first
    commit are reported in ``out/expired`` with what is missing (see ``start_enriching``).
    """
    use_rocksdb(spark)

    def write(parts: DataFrame, batch_id: int) -> None:
        joined = parts.select("key", *[F.col(n)["value"].alias(n) for n in registry.names])
        loaded = isinstance(lookup, str)
        patients = read_lookup(spark, lookup) if loaded else lookup
        full = records(joined, registry, patients, record_fields, config, text_dates=True, unique_lookup=loaded)
        lines = full.select(F.col(config.key).alias("key"), F.to_json(F.struct(*full.columns)).alias("value"))
        table = f"{out}/emitted"
        write_batch(lines, table, batch_id)
        # Read back rather than computed twice; only this batch's folder is listed.
        value = spark.read.schema("key STRING, value STRING").parquet(f"{table}/batch_id={batch_id}").select("value")
        write_batch(value, f"{out}/records", batch_id, "text")

    return start_enriching(
        spark, document_store(root), registry.names, ["value"], out, checkpoint, write,
        wait=wait, delay=delay, memory=memory, once=once, interval=config.chunk_timeout,
    )
