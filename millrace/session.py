"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: str = "8", app: str = "millrace", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.sql.streaming.noDataProgressEventInterval", "600000")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, reachable from every executor.

    Only a local master may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Folders of the intermediate tables that this application has written and not removed.
_written: list[str] = []


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, label)
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def only_results(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a ``materialize`` whose tables stay; all other intermediate tables written within the block are removed at its end.

    For work that is done when its results are written. Tables made in the block must not be read after it.
    """
    before, kept = len(_written), set()

    def keep(df: DataFrame, label: str) -> DataFrame:
        table = materialize(df, label)
        kept.add(_written[-1])
        return table

    try:
        yield keep
    finally:
        for path in [p for p in _written[before:] if p not in kept]:
            remove_table(spark, path)
        free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of work that is done. It does so when the driver's garbage collector finds the work
    gone, which with a large heap may come long after the disks are full. What the first collection lets go of holds the rest, hence
    two with a moment between."""
    spark._jvm.System.gc()
    time.sleep(0.2)
    spark._jvm.System.gc()


def remove_table(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    if path in _written:
        _written.remove(path)


def use_rocksdb(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def stream_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A session of its own for streaming queries, on the same cluster.

    A stateful query keeps the number of state partitions it was first started with, so that number
    is chosen for the stream's size and not taken over from the batch queries of the session.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    session.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    use_rocksdb(session)
    return session
