"""The completeness gate on streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.gate import progress_columns, rejection, usable, usable_acks
from millrace.session import use_rocksdb
from millrace.sinks.current import bucket_of
from millrace.streaming.combine import earliest, first_seen

# Keys are dealt over so many buckets that share a state. A micro-batch writes those anew that it touches.
KEY_BUCKETS = 256


class KeyTable:
    """The keys of a bucket and what is known of each, as one state value: columns in Arrow's stream format."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.state = handle.getValueState(name, "table BINARY")

    def get(self) -> dict[str, pd.Index | np.ndarray] | None:
        """Copies that may be written to; column ``key`` is an index."""
        now = self.state.get()
        if now is None:
            return None
        with pa.ipc.open_stream(pa.py_buffer(bytes(now[0]))) as reader:
            columns = reader.read_all()
        found = {n: columns[n].to_numpy().copy() for n in columns.column_names}
        return found | {"key": pd.Index(found["key"], dtype=object)}

    def put(self, columns: dict[str, pd.Index | np.ndarray]) -> None:
        table = pa.table({n: pa.array(_plain(v), pa.string()) if n == "key" else pa.array(v) for n, v in columns.items()})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        self.state.update((sink.getvalue().to_pybytes(),))

    def clear(self) -> None:
        self.state.clear()


def gate_stream(
    acks: DataFrame,
    sources: Sequence[str],
    key: str = "key",
    ts: str = "commit_ts",
    wait: str | None = None,
    delay: str = "0 seconds",
    memory: str = "7 days",
) -> DataFrame:
    """Each key once, in the micro-batch in which its last missing source arrives (update mode).

    A plain streaming aggregate: it runs in the JVM and combines before the shuffle. Besides the
    first time of each source it keeps the micro-batch in which that source was first seen. A key
    is complete in the greatest of these; it is emitted when that is the batch now running, which
    for a touched key is the greatest batch time in its state. Batch times come from the query's
    log, so a replayed batch emits the same keys. Should the clock be set back between batches, a
    key touched again may come out twice, but none is lost.

    Its state keeps every key for ever. With ``wait`` it is that of ``expiring_gate_stream`` instead, which lets keys go.
    Acknowledgements that cannot count are counted per micro-batch, by reason, as ``rejected`` in the query's progress.
    """
    acks = count_rejected(acks, sources, key, ts)
    if wait is not None:
        named = acks.withColumnsRenamed({key: "key", ts: "commit_ts"})
        return expiring_gate_stream(named, sources, wait, delay, memory).withColumnRenamed("key", key)
    acks = usable_acks(acks, sources, key, ts).withColumn("_batch", F.current_timestamp())
    firsts, seen = [], []
    for i, name in enumerate(sources):
        mine = F.col("source") == name
        firsts.append(F.min(F.when(mine, F.col(ts))).alias(f"_t{i}"))
        seen.append(F.min(F.when(mine, F.col("_batch"))).alias(f"_b{i}"))
    state = acks.groupBy(key).agg(
        *firsts, *seen, F.max("_batch").alias("_now"), F.count(F.lit(1)).alias("arrivals")
    )
    times = [f"_t{i}" for i in range(len(sources))]
    batches = [f"_b{i}" for i in range(len(sources))]
    found = progress_columns(sources, times)
    done = F.array_max(F.array(*batches))
    return state.where(found["complete"] & (done == F.col("_now"))).select(
        key, "arrivals", found["last"].alias("completed_ts"), found["by"].alias("completed_by")
    )


def count_rejected(acks: DataFrame, sources: Sequence[str], key: str = "key", ts: str = "commit_ts", name: str = "rejected") -> DataFrame:
    """The same stream; the query's progress tells how many of a micro-batch's acknowledgements cannot count, by reason."""
    reason = rejection(acks, sources, key, ts)
    reasons = ["missing key", "missing time", "unknown source", "write failed"]
    return acks.observe(name, *[F.count_if(reason == r).alias(r.replace(" ", "_")) for r in reasons])


def running_count_stream(acks: DataFrame, key: str = "key") -> DataFrame:
    """Acknowledgements per key so far (update mode)."""
    return acks.groupBy(key).agg(F.count(F.lit(1)).alias("running"))


class _CountGate(StatefulProcessor):
    """Emits the n-th arrival of each key of a bucket. Counts stop at n."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = KeyTable(handle, "counts")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        counts = self.counts.get()
        keys, have = (pd.Index([], dtype=object), np.zeros(0, "int64")) if counts is None else (counts["key"], counts["n"])
        wanted = None
        for batch in rows:
            both = batch if wanted is None else pd.concat([wanted, batch])
            both = both.sort_values(["commit_ts", "seq"])
            wanted = both[_rank(both["key"]) + _value_of(both["key"], keys, have) < self.n]
        new = pd.Index(wanted["key"].unique()).difference(keys, sort=False)
        keys, have = keys.append(new), np.r_[have, np.zeros(len(new), "int64")]
        last = wanted[_rank(wanted["key"]) + _value_of(wanted["key"], keys, have) == self.n - 1]
        if len(last):
            yield last[["key", "source", "commit_ts", "seq"]].assign(key=_plain(last["key"]), source=_plain(last["source"]))
        np.add.at(have, keys.get_indexer(wanted["key"]), 1)
        if len(wanted):
            self.counts.put({"key": keys, "n": have})

    def close(self) -> None:
        pass


def _plain(strings: pd.Index | pd.Series) -> np.ndarray:
    """As Python strings; what comes in several pieces cannot go out as one Arrow array."""
    return strings.to_numpy(dtype=object, na_value=None)


def _rank(keys: pd.Series) -> np.ndarray:
    """How many rows before each have its key."""
    return keys.groupby(keys, dropna=False).cumcount().to_numpy()


def _value_of(wanted: pd.Series, keys: pd.Index, values: np.ndarray) -> np.ndarray:
    """The value of each wanted key, 0 where it is not known."""
    places = keys.get_indexer(wanted)
    return np.where(places >= 0, values[places], 0) if len(values) else np.zeros(len(wanted), "int64")


def count_gate_stream(acks: DataFrame, n: int, buckets: int = KEY_BUCKETS) -> DataFrame:
    """Each key once, with the arrival that brought its count to ``n``; sources are not told apart.

    Input columns: key, source, commit_ts (timestamp), seq (bigint). Keys share the state of one of ``buckets``, so Python is
    called per bucket and not per key; the number cannot change while a query's state lives.
    """
    use_rocksdb(acks.sparkSession)
    acks = acks.select(F.col("key").cast("string").alias("key"), "source", "commit_ts", "seq")
    return (
        acks.mapInArrow(earliest(n), acks.schema)
        .withColumn("bucket", bucket_of(F.col("key"), buckets))
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=_CountGate(n),
            outputStructType=acks.schema,
            outputMode="Update",
            timeMode="None",
        )
    )


class _ExpiringGate(StatefulProcessor):
    """Waits for all sources of each key of a bucket, but not beyond ``wait_ms`` after the first arrival of the key.

    A completed or expired key stays known for another ``memory_ms``, so that redeliveries stay silent and a
    key that completes late is reported; then it leaves the state. One timer stands for the bucket, at the first time that
    one of its keys is due.
    """

    def __init__(self, sources: Sequence[str], wait_ms: int, memory_ms: int):
        self.sources = list(sources)
        self.wait_ms = wait_ms
        self.memory_ms = memory_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.keys = KeyTable(handle, "keys")
        self.alarm = handle.getValueState("alarm", "ms BIGINT")

    def _load(self) -> tuple[pd.Index, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys, and for each which sources were seen, its first time, the end of its wait, and whether that has passed."""
        now = self.keys.get()
        if now is None:
            none = np.zeros(0, "int64")
            return pd.Index([], dtype=object), np.zeros((0, len(self.sources)), bool), none, none, np.zeros(0, bool)
        seen = np.stack([now[f"seen{i}"] for i in range(len(self.sources))], axis=1)
        return now["key"], seen, now["first_ms"], now["end_ms"], now["expired"]

    def _store(self, keys, seen, first, end, expired, fired: int | None = None) -> None:
        """``fired`` is the time of the timer that has just gone off."""
        before = self.alarm.get()
        if not len(keys):
            self.keys.clear()
            self.alarm.clear()
            return
        table = {"key": keys, "first_ms": first, "end_ms": end, "expired": expired}
        self.keys.put(table | {f"seen{i}": seen[:, i] for i in range(len(self.sources))})
        due = int(np.where(expired, end + self.memory_ms, end).min())
        if before is None or before[0] != due or fired is not None:
            if before is not None and before[0] != fired:
                self.handle.deleteTimer(before[0])
            self.handle.registerTimer(due)
            self.alarm.update((due,))

    def _report(self, status: str, keys, seen, first) -> Iterator[pd.DataFrame]:
        if len(keys):
            missing = [",".join(s for s, there in zip(self.sources, row) if not there) for row in seen]
            yield pd.DataFrame({"key": _plain(keys), "status": status, "missing": missing, "first_ms": first})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        keys, seen, first, end, expired = self._load()
        news = pd.concat([b.groupby(["key", "source"], as_index=False)["first_ms"].min() for b in rows])
        new = pd.Index(news["key"].unique()).difference(keys, sort=False)
        old, added = len(keys), len(new)
        keys, expired = keys.append(new), np.r_[expired, np.zeros(added, bool)]
        seen = np.r_[seen, np.zeros((added, len(self.sources)), bool)]
        first = np.r_[first, np.full(added, np.iinfo("int64").max)]
        done = seen.all(axis=1)
        at = keys.get_indexer(news["key"])
        seen[at, pd.Index(self.sources).get_indexer(news["source"])] = True
        np.minimum.at(first, at, news["first_ms"].to_numpy("int64"))
        end = np.r_[end, first[old:] + self.wait_ms]
        complete = seen.all(axis=1) & ~done
        self._store(keys, seen, first, end, expired)
        yield from self._report("complete", keys[complete], seen[complete], first[complete])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fired = expiredTimerInfo.getExpiryTimeInMs()
        now = max(fired, timerValues.getCurrentWatermarkInMs() - 1)
        keys, seen, first, end, expired = self._load()
        forgotten = expired & (end + self.memory_ms <= now)
        over = ~expired & (end <= now)
        lost = over & ~seen.all(axis=1)
        kept = ~forgotten
        self._store(keys[kept], seen[kept], first[kept], end[kept], (expired | over)[kept], fired)
        yield from self._report("expired", keys[lost], seen[lost], first[lost])

    def close(self) -> None:
        pass


def expiring_gate_stream(
    acks: DataFrame,
    sources: Sequence[str],
    wait: str = "2 days",
    delay: str = "0 seconds",
    memory: str = "7 days",
    buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """The gate with a limit: keys that stay incomplete for ``wait`` of event time are reported
    once as ``expired``, with what is missing.

    Input columns: key, source, commit_ts (timestamp). ``delay`` is the watermark delay. The
    watermark only moves the timers: late acknowledgements still count, none is dropped. For ``memory``
    beyond the wait a key is remembered: repeats stay silent, and one that completes after all is reported
    ``complete``. Acknowledgements redelivered still later open the key anew. A row with a time but neither
    key nor source moves the clock and does nothing else: one far in the future ends the input. Keys share the state of one of
    ``buckets``, so Python is called per bucket and not per key; the number cannot change while a query's state lives.
    """
    spark = acks.sparkSession
    use_rocksdb(spark)
    tick = F.col("key").isNull() & F.col("source").isNull() & F.col("commit_ts").isNotNull()
    rows = acks.where(tick | usable(acks, sources))
    seen = rows.select(F.col("key").cast("string").alias("key"), "source", "commit_ts").mapInArrow(
        first_seen, "key STRING, source STRING, first_ts TIMESTAMP, last_ts TIMESTAMP, arrivals BIGINT"
    )
    return (
        seen.withWatermark("last_ts", delay)
        # The condition names the time, so Spark does not move it below the watermark.
        .where(F.col("key").isNotNull() | F.col("last_ts").isNull())
        # Without the watermarked column Spark has nothing to filter late rows by.
        .select("key", "source", F.unix_millis("first_ts").alias("first_ms"))
        .withColumn("bucket", bucket_of(F.col("key"), buckets))
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=_ExpiringGate(sources, _millis(spark, wait), _millis(spark, memory)),
            outputStructType="key STRING, status STRING, missing STRING, first_ms BIGINT",
            outputMode="Append",
            timeMode="EventTime",
        )
        .withColumn("first_ts", F.timestamp_millis("first_ms"))
        .drop("first_ms")
    )


def _millis(spark, interval: str) -> int:
    """Length of an interval such as "2 days" in milliseconds."""
    start = "TIMESTAMP '2000-01-01 00:00:00'"
    return spark.sql(f"SELECT unix_millis({start} + INTERVAL {interval}) - unix_millis({start})").first()[0]
