"""Starting streams and their idempotent sinks."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.session import shared_dir
from millrace.sinks.current import Files
from millrace.sinks.store import Store

def log_schema(key_type: str) -> str:
    return (
        f"source STRING, key {key_type}, status STRING, error STRING, commit_ts TIMESTAMP, seq BIGINT, "
        "job STRING, batch_id BIGINT"
    )


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Write a micro-batch to its own ``batch_id=`` folder. A replayed batch replaces itself as a whole, so
    after a restart nothing is there twice."""
    df.drop("batch_id").write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")


def start_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    fmt: str = "parquet",
    once: bool = True,
    interval: str = "20 seconds",
) -> StreamingQuery:
    """Write every micro-batch of a stream with ``write_batch``."""
    writer = stream.writeStream.outputMode(mode)
    return start(
        writer.foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id, fmt)),
        checkpoint,
        once,
        interval,
    )


def start_index(
    messages: DataFrame,
    store: Store,
    checkpoint: str,
    once: bool = False,
    interval: str = "20 seconds",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    committed: Column | None = None,
    refresh_every: int = 0,
) -> StreamingQuery:
    """Store a stream of documents and acknowledge each in the store's commit log. ``prepare`` makes documents of
    each micro-batch.

    The checkpoint names the job: several jobs may write to one store at the same time. Documents are committed at
    the time that the query's log gives their micro-batch, which a replay does not change, or at ``committed``, a column of theirs.
    After every ``refresh_every`` batches the store's current documents are brought up to date; only one job of a store
    may do that.
    """
    spark = messages.sparkSession
    job = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def write(batch: DataFrame, batch_id: int) -> None:
        at = committed if committed is not None else batch_time(spark, checkpoint, batch_id)
        store.write_batch(batch if prepare is None else prepare(batch), batch_id, at, job)
        if refresh_every and (batch_id + 1) % refresh_every == 0:
            store.refresh(spark)

    return start(messages.writeStream.foreachBatch(write), checkpoint, once, interval)


def _planned_ms(files: Files, checkpoint: str, batch_id: int) -> int:
    log = files.read(f"{checkpoint.rstrip('/')}/offsets/{batch_id}")
    return next(json.loads(line)["batchTimestampMs"] for line in log.splitlines() if "batchTimestampMs" in line)


def batch_time(spark: SparkSession, checkpoint: str, batch_id: int) -> Column:
    """When a micro-batch was planned, by the query's own log; the same for a replay."""
    return F.timestamp_millis(F.lit(_planned_ms(Files(spark, checkpoint), checkpoint, batch_id)))


class Clock:
    """Whether the clock of a query was set back: a micro-batch that is no later than one before it, by the query's log."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.checkpoint = spark, checkpoint
        self.latest: tuple[int, int] | None = None  # number of a micro-batch, and the latest time up to it

    def behind(self, batch_id: int) -> bool:
        files = Files(self.spark, self.checkpoint)
        if self.latest is None or self.latest[0] >= batch_id:
            names = [n for n, _ in files.children(f"{self.checkpoint.rstrip('/')}/offsets") if n.isdigit() and int(n) < batch_id]
            self.latest = (batch_id - 1, max((_planned_ms(files, self.checkpoint, int(n)) for n in names), default=-1))
        now, before = _planned_ms(files, self.checkpoint, batch_id), self.latest[1]
        self.latest = (batch_id, max(now, before))
        return now <= before


def start(writer: DataStreamWriter, checkpoint: str, once: bool, interval: str) -> StreamingQuery:
    """Run over what is there now and end, or for ever in intervals."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def commit_acks(spark: SparkSession, store: Store, key_type: str = "string", **options: str) -> DataFrame:
    """The commit log as a stream of acknowledgements, for the gate. It may start before the first batch, so the
    type of the store's keys has to be said.

    A rewritten batch replaces its files: those gone are skipped, the new ones are read, and the
    gate does not mind repeats.
    """
    make_folder(spark, store.log_path)
    return (
        spark.readStream.schema(log_schema(key_type))
        .option("ignoreMissingFiles", "true")
        .options(**options)
        .parquet(store.log_path)
        .drop("job")
    )


def make_folder(spark: SparkSession, path: str) -> None:
    """A folder must be there before it can be read as a stream."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


def run_available(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Process all there is, then return what was written (in fresh folders of the shared dir)."""
    spark = stream.sparkSession
    out = shared_dir(spark, label)
    query = start_batches(stream, out, f"{out}-checkpoint", mode)
    query.awaitTermination()
    written = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(written).parquet(out)
