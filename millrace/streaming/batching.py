"""Count-or-timeout chunks on streams."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.session import use_rocksdb

CHUNK = (
    "source STRING, shard INT, window_start TIMESTAMP, window_end TIMESTAMP, chunk BIGINT, n INT, "
    "reason STRING, first_us BIGINT, last_us BIGINT, documents ARRAY<STRING>"  # at most one chunk
)
# Documents of one source in one window that a shard is to take.
SHARD_DOCUMENTS = 100_000


class _Chunks(StatefulProcessor):
    """Collects documents of one (source, shard, window); never holds a full chunk in state.

    Documents come and go as tables of an Arrow batch: waiting ones are appended to the state, and read from it only
    when they fill a chunk. The number of the next chunk outlives the window by ``memory_ms``, so late documents get
    chunks of their own.
    """

    def __init__(self, rows: int, memory_ms: int):
        self.rows = rows
        self.memory_ms = memory_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "us BIGINT, value STRING")
        self.closed = handle.getValueState("closed", "n BIGINT, waiting INT, end_ms BIGINT, fired BOOLEAN")

    def _waiting(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.pending.get()), columns=["us", "value"])

    def _chunks(self, key, number: int, documents: pd.DataFrame, reason: str) -> pd.DataFrame:
        """The documents as chunks, in order of arrival."""
        source, shard, start, end = key
        firsts = range(0, len(documents), self.rows)
        us, values = documents["us"].to_numpy(), documents["value"].to_numpy()
        parts = [slice(i, i + self.rows) for i in firsts]
        return pd.DataFrame(
            {
                "source": source,
                "shard": shard,
                "window_start": start,
                "window_end": end,
                "chunk": [number + i for i in range(len(parts))],
                "n": [len(values[p]) for p in parts],
                "reason": reason,
                "first_us": [int(us[p].min()) for p in parts],
                "last_us": [int(us[p].max()) for p in parts],
                "documents": [list(values[p]) for p in parts],
            }
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.closed.get()
        number, held, end_ms, fired = before if before else (0, 0, None, False)
        for batch in rows:
            end_ms = int(batch["end_ms"].iloc[0])
            documents = batch[["us", "value"]]
            if held + len(documents) >= self.rows:
                if held:
                    documents = pd.concat([self._waiting(), documents], ignore_index=True)
                    self.pending.clear()
                whole = len(documents) // self.rows * self.rows
                yield self._chunks(key, number, documents.iloc[:whole], "count")
                number, held, documents = number + whole // self.rows, 0, documents.iloc[whole:]
            if len(documents):
                self.pending.appendList(list(documents.itertuples(index=False, name=None)))
                held += len(documents)
        # A window that has passed fires once more for its late documents.
        if before is None or fired:
            self.handle.registerTimer(end_ms)
        self.closed.update((number, held, end_ms, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        before = self.closed.get()
        if not before:
            return
        number, held, end_ms, _ = before
        if held:
            yield self._chunks(key, number, self._waiting(), "timeout")
            self.pending.clear()
            number += 1
        if expiredTimerInfo.getExpiryTimeInMs() >= end_ms + self.memory_ms:
            self.closed.clear()
        else:
            self.closed.update((number, 0, end_ms, True))
            self.handle.registerTimer(end_ms + self.memory_ms)

    def close(self) -> None:
        pass


def session_counts_stream(
    df: DataFrame, ts: str, gap_seconds: int, groups: Sequence[str], delay: str
) -> DataFrame:
    """Rows per session, a session ending when nothing comes for ``gap_seconds`` (append mode): out when the watermark,
    ``delay`` behind the latest time, has passed its end.

    Sessions are merged in each input task before the shuffle (``stream_session`` sees to that), then with those of the state; a late
    row may join two of them. A row that is later than ``delay`` and would begin a session of its own is dropped by
    Spark; the query's progress counts these (``numRowsDroppedByWatermark``).
    """
    # Rows exactly a gap apart share a session, as in ``session_counts``; Spark's windows end before their last instant.
    window = F.session_window(ts, f"{gap_seconds} seconds 1 microsecond")
    counted = df.withWatermark(ts, delay).groupBy(*groups, window.alias("_w"))
    return counted.agg(F.min(ts).alias("session_start"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n")).drop("_w")


def measured_shards(history: DataFrame, timeout: str = "20 seconds", documents: int = SHARD_DOCUMENTS) -> dict[str, int]:
    """How many shards each source needs, so that none takes more than about ``documents`` in one window: from the
    source and the time (``ts``) of documents that came before. One row per source comes back."""
    sizes = history.groupBy("source", F.window("ts", timeout)).count().groupBy("source").agg(F.max("count").alias("most"))
    return {r["source"]: -(-r["most"] // documents) for r in sizes.where("source IS NOT NULL").collect()}


def chunk_stream(
    documents: DataFrame,
    shard: Column | None = None,
    shards: int | Mapping[str, int] = 8,
    rows: int = 50,
    timeout: str = "20 seconds",
    delay: str | None = None,
    memory_seconds: int = 7 * 86_400,
) -> DataFrame:
    """Chunks of at most ``rows`` documents per source, closed early when their window ends.

    Input columns: source, ts (timestamp), seq (bigint, identifies a document of its source), value.
    Each source is spread over ``shards`` by its documents, not by key, so neither a hot key nor a
    hot source lands in one task; ``measured_shards`` gives a number for each source by its volume (others get 8). With ``delay`` windows follow event time under that watermark
    delay; without, they follow the time of arrival. The numbers of a window's chunks do not repeat
    for documents up to ``memory_seconds`` late. A row with a time but no source moves the clock and does
    nothing else: one far in the future ends the input and closes every window.
    """
    use_rocksdb(documents.sparkSession)
    by_arrival = delay is None
    if shard is None:
        number = F.lit(8 if isinstance(shards, Mapping) else shards)
        for source, own in shards.items() if isinstance(shards, Mapping) else []:
            number = F.when(F.col("source") == source, F.lit(max(1, own))).otherwise(number)
        shard = F.pmod(F.xxhash64("source", "seq"), number)
    if by_arrival:
        documents = documents.withColumn("ts", F.current_timestamp())
    keyed = documents.select(
        "source", shard.cast("int").alias("shard"), F.window("ts", timeout).alias("w"), "ts", "value"
    ).select(
        "source",
        "shard",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "ts",
        F.unix_micros("ts").alias("us"),
        "value",
        F.unix_millis("w.end").alias("end_ms"),
    )
    if not by_arrival:
        # The watermark only moves the timers. Without its column in the operator's input Spark
        # drops no late document; that one gets a chunk of its own.
        keyed = keyed.withColumn("_clock", F.col("ts")).withWatermark("_clock", delay)
        # The condition names the clock, so Spark does not move it below the watermark.
        keyed = keyed.where(F.col("source").isNotNull() | F.col("_clock").isNull()).drop("_clock")
    else:
        keyed = keyed.where(F.col("source").isNotNull())
    chunks = keyed.drop("ts").groupBy("source", "shard", "window_start", "window_end").transformWithStateInPandas(
        statefulProcessor=_Chunks(rows, 1000 * memory_seconds),
        outputStructType=CHUNK,
        outputMode="Append",
        timeMode="ProcessingTime" if by_arrival else "EventTime",
    )
    times = [F.timestamp_micros(f"{t}_us").alias(f"{t}_ts") for t in ("first", "last")]
    return chunks.select("source", "shard", "window_start", "window_end", "chunk", "n", "reason", *times, "documents")
