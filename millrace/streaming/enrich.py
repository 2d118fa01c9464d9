"""Gate and N-way join of streams: with the parts in a store, or in one streaming aggregate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sinks.store import Store
from millrace.streaming.gate import gate_stream
from millrace.streaming.jobs import Clock, commit_acks, make_folder, start, write_batch


def start_enriching(
    spark: SparkSession,
    store: Store,
    sources: Sequence[str],
    fields: Sequence[str],
    out: str,
    checkpoint: str,
    use: Callable[[DataFrame, int], None],
    key_type: str = "string",
    wait: str | None = None,
    delay: str = "0 seconds",
    memory: str = "7 days",
    once: bool = False,
    interval: str = "20 seconds",
    **options: str,
) -> StreamingQuery:
    """The gate over the commit log of ``store``, and the join of each micro-batch's completed keys with their stored parts.

    The state holds keys and which sources have committed, never a part. Completed keys are written to
    ``out/completed``, then ``use`` gets their parts as ``Store.parts`` gives them (``fields`` of the newest document of each source
    at that moment) and the number of the micro-batch, if it completed any; only the buckets of these keys are read, and what was
    stored since the store's last refresh. A replayed micro-batch calls it again. No key is completed twice, whatever the clock does.

    With ``wait`` a key that stays incomplete for so long after its first commit goes to ``out/expired`` with what is missing, and
    leaves the state ``memory`` after that; see ``expiring_gate_stream``. Rows of the log that cannot count (refused documents, other
    sources) are counted per micro-batch under the name ``rejected`` in the query's progress.
    """
    acks = commit_acks(spark, store, key_type, **options)
    gated = gate_stream(acks, sources, wait=wait, delay=delay, memory=memory)
    clock = Clock(spark, checkpoint)
    for name in ("completed", "expired"):
        make_folder(spark, f"{out}/{name}")

    def write(batch: DataFrame, batch_id: int) -> None:
        # Written first: what is read back is the same however often it is read, and is planned adaptively.
        folder = f"{out}/gated"
        write_batch(batch, folder, batch_id)
        found = spark.read.schema(batch.schema).parquet(f"{folder}/batch_id={batch_id}")
        if wait is not None:
            write_batch(found.where("status = 'expired'").drop("status"), f"{out}/expired", batch_id)
            found = found.where("status = 'complete'")
        elif clock.behind(batch_id):
            # Only then may the gate name a key again that it has named before.
            earlier = spark.read.schema(f"key {key_type}, batch_id BIGINT").parquet(f"{out}/completed").where(F.col("batch_id") < batch_id)
            found = found.join(earlier.select(F.col("key").cast("string").alias("_before")), F.col("key").cast("string") == F.col("_before"), "left_anti")
        keys = found.select(F.col("key").cast(key_type).alias("key"))
        write_batch(keys, f"{out}/completed", batch_id)
        done = spark.read.schema(keys.schema).parquet(f"{out}/completed/batch_id={batch_id}")
        if not done.isEmpty():
            use(store.parts(spark, done, sources, fields), batch_id)

    mode = "update" if wait is None else "append"
    return start(gated.writeStream.outputMode(mode).foreachBatch(write), checkpoint, once, interval)


def expired_keys(spark: SparkSession, out: str) -> DataFrame:
    """key, missing (names with commas), first_ts of the keys that ``start_enriching`` gave up."""
    schema = "key STRING, missing STRING, first_ts TIMESTAMP, batch_id BIGINT"
    return spark.read.schema(schema).parquet(f"{out}/expired").drop("batch_id")


def enrich_stream(
    messages: DataFrame, sources: Sequence[str], emitted: DataFrame | None = None
) -> DataFrame:
    """Each complete key once, with the JSON text of its newest part from every source, in the
    micro-batch in which the last missing part arrives (update mode).

    Input columns: key, source, version (any ordered type), value (JSON text). Output: key and one
    text column per source, ready for ``parse_typed`` and ``lookup_join``.

    It runs in the JVM and combines before the shuffle, so a hot key sends one row per input task.
    As in ``gate_stream``, a key is emitted in the batch that is the greatest of its sources' first
    batches. ``emitted`` may be the stream of keys (column ``key``) that this query has written:
    their parts are then replaced in the state by an empty mark that no later part outranks, and
    the state holds parts of open keys only.
    """
    known = reduce(and_, [F.col(c).isNotNull() for c in ("key", "version", "value")])
    rows = messages.where(F.col("source").isin(*sources) & known).select(
        F.col("key").cast("string").alias("key"),
        "source",
        F.struct(F.lit(False).alias("closed"), F.col("version"), F.col("value")).alias("part"),
    )
    if emitted is not None:
        rows = rows.unionByName(
            emitted.select(
                F.col("key").cast("string").alias("key"),
                F.lit(None).cast("string").alias("source"),
                F.struct(
                    F.lit(True).alias("closed"),
                    F.lit(None).cast(messages.schema["version"].dataType).alias("version"),
                    F.lit(None).cast("string").alias("value"),
                ).alias("part"),
            )
        )
    rows = rows.withColumn("_batch", F.current_timestamp())

    parts, batches = [], []
    for i, name in enumerate(sources):
        mine = F.col("source") == name
        parts.append(F.max(F.when(mine | F.col("source").isNull(), F.col("part"))).alias(f"_p{i}"))
        batches.append(F.min(F.when(mine, F.col("_batch"))).alias(f"_b{i}"))
    state = rows.groupBy("key").agg(*parts, *batches, F.max("_batch").alias("_now"))

    names = [f"_b{i}" for i in range(len(sources))]
    complete = reduce(and_, [F.col(b).isNotNull() for b in names])
    done = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    # A key whose parts have been let go is out already, whatever the clock says now.
    still_open = reduce(and_, [~F.col(f"_p{i}.closed") for i in range(len(sources))])
    return state.where(complete & still_open & (done == F.col("_now"))).select(
        "key", *[F.col(f"_p{i}.value").alias(name) for i, name in enumerate(sources)]
    )
