"""Streams over several micro-batches, with repeats, lateness and restarts."""

import time
from glob import glob
from datetime import datetime, timedelta
from itertools import permutations

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from millrace.operators.batching import session_counts
from millrace.operators.gate import gate_distinct
from millrace.operators.ingest import ingest_counts
from millrace.plans import stream_queries
from millrace.sources import read_delimited, read_file_streams
from millrace.sources.delimited import good_rows, quarantined_rows, split_delimited
from millrace.streaming.batching import chunk_stream, session_counts_stream
from millrace.streaming.enrich import enrich_stream
from millrace.streaming.gate import count_gate_stream, expiring_gate_stream, gate_stream
from millrace.streaming.ingest import ingest_totals, ingested_rows, start_ingest
from millrace.streaming.jobs import commit_acks, run_available, start, start_batches, start_index
from millrace.sinks.current import Files
from millrace.sinks.store import Store

T0 = datetime(2024, 1, 1)
ACK = "key STRING, source STRING, commit_ts TIMESTAMP, seq BIGINT"


class Feed:
    """A folder that grows by one file per batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", "1")
        return reader.parquet(self.path)


def acks(text, start=0):
    rows = []
    for i, pair in enumerate(text.split()):
        key, source = pair.split(":")
        rows.append((key, source, T0 + timedelta(seconds=start + i), start + i))
    return rows


def test_gate_emits_once_over_batches_and_restarts(spark, folder):
    feed, out, cp = Feed(spark, folder("acks"), ACK), folder("out"), folder("cp")

    def run():
        start_batches(gate_stream(feed.stream(), list("abc")), out, cp, mode="update").awaitTermination()
        return sorted(r["key"] for r in spark.read.parquet(out).collect())

    feed.add(acks("k:a k:b j:a"))
    feed.add(acks("k:c k:a j:b", 10))
    assert run() == ["k"]
    feed.add(acks("k:a k:b k:c j:a", 20))  # redelivered: k stays silent
    assert run() == ["k"]
    feed.add(acks("j:c i:a", 30))
    assert run() == ["j", "k"]
    batch = gate_distinct(spark.read.schema(ACK).parquet(feed.path), list("abc"))
    assert sorted(r["key"] for r in batch.collect()) == ["j", "k"]


@pytest.mark.parametrize("order", list(permutations(range(3)))[::2])
def test_gate_does_not_depend_on_batch_order(spark, folder, order):
    feed = Feed(spark, folder("acks"), ACK)
    batches = ["k:a j:b i:c", "k:b j:c i:c", "k:c j:a i:a"]
    for n, i in enumerate(order):
        feed.add(acks(batches[i], 10 * n))
    done = run_available(gate_stream(feed.stream(), list("abc")), "gate", "update")
    assert sorted(r["key"] for r in done.collect()) == ["j", "k"]


def test_count_gate_counts_repeats(spark, folder):
    feed = Feed(spark, folder("acks"), ACK)
    feed.add(acks("k:a k:a j:a"))
    feed.add(acks("k:b k:c k:d k:a", 10))
    done = run_available(count_gate_stream(feed.stream(), 4), "count")
    assert [(r["key"], r["seq"]) for r in done.collect()] == [("k", 11)]


def test_expiring_gate_reports_and_keeps_late_rows(spark, folder):
    feed = Feed(spark, folder("acks"), ACK)
    hour = 3600
    feed.add(acks("k:a j:a i:a"))
    feed.add(acks("k:b z:a", 30 * 60))
    feed.add(acks("y:a", 3 * hour))  # moves the clock beyond the wait of j and i
    feed.add(acks("x:a", 4 * hour))
    feed.add(acks("late:a late:b", 60))  # older than the watermark, counts all the same
    feed.add(acks("w:a", 4 * hour + 1800))
    gated = expiring_gate_stream(feed.stream(), ["a", "b"], wait="2 hours", delay="0 seconds")
    rows = [(r["key"], r["status"], r["missing"]) for r in run_available(gated, "expiring").collect()]
    assert sorted(rows) == [
        ("i", "expired", "b"),
        ("j", "expired", "b"),
        ("k", "complete", ""),
        ("late", "complete", ""),
        ("z", "expired", "b"),
    ]


def test_enrich_stream_joins_newest_parts(spark, folder):
    schema = "key STRING, source STRING, version BIGINT, value STRING"
    feed = Feed(spark, folder("parts"), schema)
    feed.add([("k", "a", 1, "a1"), ("k", "a", 3, "a3"), ("j", "b", 1, "jb"), (None, "a", 1, "x")])
    feed.add([("k", "a", 2, "a2"), ("k", "zz", 9, "?"), ("i", "a", 1, "ia"), ("i", "b", 1, "ib")])
    feed.add([("k", "b", 1, "b1"), ("i", "a", 5, "after")])
    done = run_available(enrich_stream(feed.stream(), ["a", "b"]), "enriched", "update")
    assert sorted((r["key"], r["a"], r["b"]) for r in done.collect()) == [("i", "ia", "ib"), ("k", "a3", "b1")]


def test_hot_key_is_combined_before_the_shuffle(spark, folder):
    schema = "key STRING, source STRING, version BIGINT, value STRING"
    path = folder("hot")
    spark.range(30000).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS key", "IF(id % 2 = 0, 'a', 'b') AS source",
        "id AS version", "CAST(id AS STRING) AS value",
    ).write.parquet(path)
    stream = spark.readStream.schema(schema).parquet(path)
    done = run_available(enrich_stream(stream, ["a", "b"]), "hot", "update")
    assert [(r["key"], r["a"], r["b"]) for r in done.collect()] == [("hot", "29994", "29997")]


def test_parts_of_emitted_keys_leave_the_state(spark, folder):
    schema = "key STRING, source STRING, version BIGINT, value STRING"
    feed, out, cp = Feed(spark, folder("parts"), schema), folder("out"), folder("cp")
    spark.createDataFrame([], "key STRING, batch_id BIGINT").write.partitionBy("batch_id").parquet(out)

    def run():
        emitted = spark.readStream.schema("key STRING, batch_id BIGINT").parquet(out).select("key")
        stream = enrich_stream(feed.stream(), ["a", "b"], emitted)
        start_batches(stream, out, cp, mode="update").awaitTermination()
        return sorted((r["key"], r["a"], r["b"]) for r in spark.read.parquet(out).collect())

    feed.add([("k", "a", 1, "a1"), ("k", "b", 1, "b1"), ("j", "a", 1, "ja")])
    assert run() == [("k", "a1", "b1")]
    feed.add([("k", "a", 7, "again"), ("i", "a", 1, "ia")])
    assert run() == [("k", "a1", "b1")]
    state = {r["key"]["key"]: r["value"] for r in spark.read.format("statestore").load(cp).collect()}
    held = {k: [p["value"] for p in v if hasattr(p, "closed") and p is not None] for k, v in state.items()}
    assert held == {"k": [None, None], "j": ["ja"], "i": ["ia"]}
    feed.add([("j", "b", 1, "jb")])
    assert run() == [("j", "ja", "jb"), ("k", "a1", "b1")]


def test_chunks_lose_no_document(spark, folder):
    feed = Feed(spark, folder("docs"), "source STRING, ts TIMESTAMP, seq BIGINT, value STRING")

    def docs(n, start, second):
        return [("s", T0 + timedelta(seconds=second), start + i, str(start + i)) for i in range(n)]

    feed.add(docs(120, 0, 1))
    feed.add(docs(10, 200, 30))
    feed.add(docs(1, 300, 90))
    feed.add(docs(5, 400, 2))  # late: its window closed long ago
    feed.add(docs(1, 500, 150))
    chunks = chunk_stream(feed.stream(), shards=1, rows=50, timeout="20 seconds", delay="0 seconds")
    rows = run_available(chunks, "chunks").collect()
    assert sorted((r["n"], r["reason"]) for r in rows) == [
        (1, "timeout"), (5, "timeout"), (10, "timeout"), (20, "timeout"), (50, "count"), (50, "count"),
    ]
    documents = [d for r in rows for d in r["documents"]]
    assert len(documents) == len(set(documents)) == 136  # the last window is still open
    numbers = [(r["window_start"], r["chunk"]) for r in rows]
    assert len(numbers) == len(set(numbers))  # the late documents have a chunk of their own


def test_chunks_by_time_of_arrival(spark, folder):
    feed = Feed(spark, folder("docs"), "source STRING, ts TIMESTAMP, seq BIGINT, value STRING")
    feed.add([("s", T0, i, str(i)) for i in range(70)])
    out = folder("out")
    chunks = chunk_stream(feed.stream(), shards=1, rows=50, timeout="5 seconds")
    query = start_batches(chunks, out, folder("cp"), once=False, interval="1 second")
    try:
        deadline = time.time() + 90
        rows = []
        while time.time() < deadline and sum(r["n"] for r in rows) < 70:
            time.sleep(2)
            assert query.exception() is None
            try:
                rows = spark.read.parquet(out).collect()
            except AnalysisException:
                pass  # nothing written yet
    finally:
        query.stop()
    assert sorted((r["n"], r["reason"]) for r in rows) == [(20, "timeout"), (50, "count")]


def test_index_then_gate_over_the_commit_log(spark, folder):
    schema = "source STRING, pcn STRING, v INT, x STRING"
    feed, store = Feed(spark, folder("docs"), schema), Store(folder("store"), "pcn", ["v"])
    feed.add([("a", "k", 1, "x"), ("a", None, 1, "no key")])
    feed.add([("b", "k", 1, "y"), ("b", "j", 1, "z")])
    start_index(feed.stream(), store, folder("cp"), once=True).awaitTermination()
    done = run_available(gate_stream(commit_acks(spark, store), ["a", "b"]), "gate", "update")
    assert [r["key"] for r in done.collect()] == ["k"]
    assert store.log(spark).where(F.col("status") == "failed").count() == 1


def test_same_batch_written_again_is_there_once(spark, folder):
    feed, out = Feed(spark, folder("docs"), "x INT"), folder("out")
    feed.add([(1,), (2,)])
    for _ in range(2):  # two queries that both run batch 0: as after a crash before the commit
        start_batches(feed.stream(), out, folder("cp")).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_a_crash_between_data_and_log_loses_and_repeats_nothing(spark, folder):
    schema = "source STRING, pcn STRING, v INT, x STRING"

    class Fragile(Store):
        crash = True

        def _read(self, spark, path=None):
            if self.crash:
                raise RuntimeError("lost between the data and the log")
            return super()._read(spark, path)

    feed, store, cp = Feed(spark, folder("docs"), schema), Fragile(folder("store"), "pcn", ["v"]), folder("cp")
    feed.add([("a", "k", 1, "x"), ("b", "k", 1, "y")])
    with pytest.raises(StreamingQueryException):
        start_index(feed.stream(), store, cp, once=True).awaitTermination()
    store.crash = False
    feed.add([("a", "j", 1, "x")])
    start_index(feed.stream(), store, cp, once=True).awaitTermination()
    assert store.documents(spark).count() == 3
    assert sorted((r["source"], r["key"]) for r in store.log(spark).collect()) == [("a", "j"), ("a", "k"), ("b", "k")]


def test_a_crash_in_the_sink_does_not_lose_a_completed_key(spark, folder):
    feed, out, cp = Feed(spark, folder("acks"), ACK), folder("out"), folder("cp")
    feed.add(acks("k:a k:b j:a"))
    broken = gate_stream(feed.stream(), ["a", "b"]).writeStream.outputMode("update")

    def fail(batch, batch_id):
        raise RuntimeError("sink down")

    with pytest.raises(StreamingQueryException):
        start(broken.foreachBatch(fail), cp, True, "1 second").awaitTermination()
    feed.add(acks("j:b k:a", 10))
    start_batches(gate_stream(feed.stream(), ["a", "b"]), out, cp, mode="update").awaitTermination()
    assert sorted(r["key"] for r in spark.read.parquet(out).collect()) == ["j", "k"]


def test_delimited_files_as_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.txt").write_text("k\tv\n1\tx\n2\n3\ty\tz")
    (tmp_path / "in" / "1.txt").write_text("k\tv\n4\tx\n5\t")
    lines = read_delimited(spark, str(tmp_path / "in"), ["k", "v"], streaming=True, maxFilesPerTrigger="1")
    rows = run_available(lines, "lines").collect()
    assert sorted(r["k"] for r in rows if not r["_bad"]) == ["1", "3", "4"]
    assert sorted(r["_line"] for r in rows if r["_bad"]) == ["2", "5\t"]
    counts = run_available(ingest_counts(lines.withColumn("source", F.lit("s"))), "counts", "update")
    last = counts.orderBy(F.desc("batch_id")).first()
    assert (last["good"], last["malformed"]) == (3, 2)
    with pytest.raises(ValueError):
        read_delimited(spark, str(tmp_path / "in"), ["k", "v"], streaming=True, positions=True)


def test_a_line_like_the_header_is_data_on_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "xyz":
        (tmp_path / "in" / name).write_text("a\tb\n1\t2\na\tb\n3\t4\n" * 3)
    (tmp_path / "in" / "no_header").write_text("5\t6\na\tb\n")
    for options in ({}, {"maxFilesPerTrigger": "1"}):
        lines = read_delimited(spark, str(tmp_path / "in"), ["a", "b"], streaming=True, **options)
        rows = run_available(lines, f"like_header_{len(options)}").collect()
        got = sorted((r["a"], r["b"]) for r in rows if not r["_bad"])
        assert got == [("1", "2")] * 9 + [("3", "4")] * 9 + [("5", "6")] + [("a", "b")] * 16


def test_folders_as_one_stream(spark, folder):
    schema = spark.range(1).schema
    folders = {name: folder(name) for name in ("a", "b")}
    for i, path in enumerate(folders.values()):
        spark.range(i, i + 2).write.parquet(path)
    rows = run_available(read_file_streams(spark, folders, schema), "union").collect()
    assert sorted((r["source"], r["id"]) for r in rows) == [("a", 0), ("a", 1), ("b", 1), ("b", 2)]


def test_redelivery_after_the_wait_stays_silent(spark, folder):
    feed = Feed(spark, folder("acks"), ACK)
    hour = 3600
    feed.add(acks("k:a k:b j:a"))
    feed.add(acks("z:a", 3 * hour))  # beyond the wait of k and j
    feed.add(acks("z:a", 4 * hour))
    feed.add(acks("k:a k:b", 5 * hour))  # redelivered
    feed.add(acks("j:b", 5 * hour))  # completes after all
    gated = expiring_gate_stream(feed.stream(), ["a", "b"], wait="2 hours", memory="1 day")
    rows = [(r["key"], r["status"], r["missing"]) for r in run_available(gated, "expiring").collect()]
    expected = [("j", "complete", ""), ("j", "expired", "b"), ("k", "complete", ""), ("z", "expired", "b")]
    assert sorted(rows) == expected


def test_many_sources_and_the_end_of_input(spark, folder):
    feed, names = Feed(spark, folder("acks"), ACK), [f"s{i}" for i in range(70)]
    feed.add(acks(" ".join(f"k:{n}" for n in names[:40])))
    feed.add(acks(" ".join([*(f"k:{n}" for n in names[40:]), "j:s0", "i:zz"]), 100))
    feed.add([(None, None, T0 + timedelta(days=9), None)])
    rows = run_available(expiring_gate_stream(feed.stream(), names, "2 hours"), "expiring").collect()
    found = {r["key"]: (r["status"], r["missing"]) for r in rows}
    assert found == {"k": ("complete", ""), "j": ("expired", ",".join(names[1:]))}
    assert len(rows) == 2


def test_the_end_of_input_closes_the_last_chunk(spark, folder):
    feed = Feed(spark, folder("docs"), "source STRING, ts TIMESTAMP, seq BIGINT, value STRING")
    feed.add([("s", T0, i, str(i)) for i in range(7)])
    feed.add([(None, T0 + timedelta(days=1), None, None)])
    chunks = chunk_stream(feed.stream(), shards=1, rows=5, timeout="20 seconds", delay="0 seconds")
    rows = run_available(chunks, "chunks").collect()
    assert sorted((r["source"], r["n"], r["reason"]) for r in rows) == [("s", 2, "timeout"), ("s", 5, "count")]


def test_late_rows_join_two_sessions(spark, folder):
    schema = "g STRING, ts TIMESTAMP, x INT"
    feed = Feed(spark, folder("events"), schema)

    def at(*seconds, g="a"):
        return [(g, T0 + timedelta(seconds=s), s) for s in seconds]

    feed.add(at(0, 10, 40) + at(0, g="b"))
    feed.add(at(60, 100))
    feed.add(at(25, 50))  # 10, 25, 40, 50, 60 now follow each other within 15 seconds
    feed.add(at(75 + 40) + at(15, g="b"))
    feed.add([(None, T0 + timedelta(days=1), None)])
    sessions = session_counts_stream(feed.stream(), "ts", 15, ["g"], delay="2 minutes")
    got = run_available(sessions, "sessions").where("g IS NOT NULL").collect()
    rows = sorted((r["g"], (r["session_start"] - T0).seconds, (r["last_ts"] - T0).seconds, r["n"]) for r in got)
    assert rows == [("a", 0, 60, 6), ("a", 100, 115, 2), ("b", 0, 15, 2)]
    table = spark.read.schema(schema).parquet(feed.path).where("g IS NOT NULL")
    batch = session_counts(table, "ts", 15, ["g"]).collect()
    assert sorted((r["g"], (r["session_start"] - T0).seconds, (r["last_ts"] - T0).seconds, r["n"]) for r in batch) == rows


def test_ingest_counts_survive_a_replay(spark, folder):
    feed, out, cp = Feed(spark, folder("lines"), "source STRING, value STRING"), folder("out"), folder("cp")

    def run():
        split = split_delimited(feed.stream(), ["a", "b"])
        start_ingest(split, ["s", "t"], out, cp, once=True).awaitTermination()
        return split

    feed.add([("s", "1\t2"), ("s", "bad"), ("t", "1\t2"), ("u", "1\t2"), (None, "bad")])
    feed.add([("s", "3\t4"), ("t", "")])
    run()
    Files(spark, cp).delete(f"{cp}/commits/1")
    Files(spark, cp).delete(f"{cp}/commits/.1.crc")
    split = run()  # the last micro-batch once more
    assert {tuple(r) for r in ingest_totals(spark, out).collect()} == {("s", 2, 1), ("t", 1, 1), (None, 1, 1)}
    rows = ingested_rows(spark, out, split)
    assert rows.count() == 7 and quarantined_rows(rows).count() == 3
    assert sorted((r["source"], r["a"], r["b"]) for r in good_rows(rows).collect()) == [
        ("s", "1", "2"), ("s", "3", "4"), ("t", "1", "2"), ("u", "1", "2"),
    ]


def test_gates_keep_one_state_for_many_keys(spark, folder):
    feed = Feed(spark, folder("acks"), ACK)
    first, second = " ".join(f"k{i}:a" for i in range(300)), " ".join(f"k{i}:b k{i}:b" for i in range(0, 400, 2))
    feed.add(acks(first))
    feed.add(acks(second, 1000))
    feed.add([(None, None, T0 + timedelta(days=9), None)])

    def run(gated):
        out = folder("out")
        query = start_batches(gated, out, folder("cp"))
        query.awaitTermination()
        assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 3 * 8
        return spark.read.parquet(out).collect()

    counted = {r["key"]: r["seq"] for r in run(count_gate_stream(feed.stream().where("key IS NOT NULL"), 2, buckets=8))}
    assert counted == {f"k{i}": 1000 + i + (i >= 300) for i in range(0, 400, 2)}
    rows = [(r["key"], r["status"], r["missing"]) for r in run(expiring_gate_stream(feed.stream(), ["a", "b"], "2 hours", buckets=8))]
    expected = [(f"k{i}", "complete", "") for i in range(0, 300, 2)] + [(f"k{i}", "expired", "b") for i in range(1, 300, 2)]
    assert sorted(rows) == sorted(expected + [(f"k{i}", "expired", "a") for i in range(300, 400, 2)])


def test_micro_batches_of_large_tables_have_several_files(spark, monkeypatch):
    monkeypatch.setattr(stream_queries, "ROWS_PER_FILE", 25)
    for label, stream in (
        ("steps", stream_queries.arriving_in_steps(spark.range(400), "steps")),
        ("pieces", stream_queries.arriving_one_by_one([spark.range(i, i + 100) for i in range(0, 400, 100)], "pieces", 400)),
    ):
        rows = run_available(stream, "read").collect()
        assert sorted(r["id"] for r in rows) == list(range(400)) and {r["batch_id"] for r in rows} == set(range(4))
        assert len(glob(f"{spark.conf.get('spark.checkpoint.dir')}/{label}-*/part-*")) == 16
