import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.batching import assign_chunks, chunk_summary, session_counts
from millrace.sinks.lookup import load_lookup
from millrace.sinks.store import Store, write_status_counts
from millrace.sinks.text import ack_messages, topic_messages, write_json_text, write_topic
from millrace.sources.streams import read_topics, topic_acks

DOC = "source STRING, pcn STRING, v INT, x STRING"


def store(folder):
    return Store(folder("store"), "pcn", ["v"])


def test_upsert_log_and_replay(spark, folder):
    s = store(folder)
    first = spark.createDataFrame([("a", "k", 1, "one"), ("a", None, 1, "lost"), ("007", "k", 1, "b")], DOC)
    second = spark.createDataFrame([("a", "k", 2, "two"), ("a", "j", None, "nov")], DOC)
    s.write_batch(first, 0)
    s.write_batch(second, 1)
    s.write_batch(second, 1)  # the same batch again
    assert {(r["source"], r["pcn"], r["x"]) for r in s.current(spark).collect()} == {
        ("a", "k", "two"),
        ("007", "k", "b"),
    }
    assert s.documents(spark).count() == 3 and s.documents(spark, "a").count() == 2
    log = s.log(spark)
    assert log.count() == 5
    assert {(r["status"], r["error"]) for r in log.collect()} == {
        ("ok", None),
        ("failed", "missing key"),
        ("failed", "missing version"),
    }
    assert sorted(r["x"] for r in s.rejected(spark).collect()) == ["lost", "nov"]
    counts = {(r["batch_id"], r["source"]): (r["succeeded"], r["failed"]) for r in write_status_counts(log).collect()}
    assert counts == {(0, "a"): (1, 1), (0, "007"): (1, 0), (1, "a"): (1, 1)}


def test_late_old_version_does_not_win(spark, folder):
    s = store(folder)
    s.write_batch(spark.createDataFrame([("a", "k", 5, "new")], DOC), 0)
    s.write_batch(spark.createDataFrame([("a", "k", 4, "old")], DOC), 1)
    assert s.current(spark).first()["x"] == "new"


def test_compaction_keeps_the_current_state(spark, folder):
    s = store(folder)
    for b in range(4):
        s.write_batch(spark.createDataFrame([("a", "k", b, str(b)), ("a", f"k{b}", b, "x")], DOC), b)
    small = s.compact(spark, folder("compact"), 3)
    want = sorted(map(tuple, s.current(spark).select("source", "pcn", "v", "x").collect()))
    assert sorted(map(tuple, small.current(spark).select("source", "pcn", "v", "x").collect())) == want
    assert small.documents(spark).count() == 5
    small.write_batch(spark.createDataFrame([("a", "k", 9, "nine")], DOC), 9)
    assert small.current(spark).where("pcn = 'k'").first()["x"] == "nine"


def test_compaction_stops_at_a_batch(spark, folder):
    s = store(folder)
    for b in range(3):
        s.write_batch(spark.createDataFrame([("a", "k", b, str(b))], DOC), b)
    assert s.compact(spark, folder("compact"), 1).current(spark).first()["x"] == "1"


def test_empty_batch(spark, folder):
    s = store(folder)
    s.write_batch(spark.createDataFrame([], DOC), 0)
    s.write_batch(spark.createDataFrame([("a", "k", 1, "x")], DOC), 1)
    s.write_batch(spark.createDataFrame([], DOC), 2)
    assert s.log(spark).count() == 1


def test_lookup_reload_does_not_duplicate(spark, folder):
    path = folder("lookup")
    dim = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", None)], "patientID STRING, n STRING")
    assert load_lookup(dim, path, "patientID").count() == 2
    rows = load_lookup(dim, path, "patientID").collect()
    assert sorted((r["patientID"], r["n"]) for r in rows) == [("p", "b"), ("q", None)]


def test_json_text_overwrites(spark, folder):
    path = folder("json")
    df = spark.range(5).selectExpr("id", "IF(id = 0, NULL, 'x') AS x")
    write_json_text(df, path)
    write_json_text(df, path)
    rows = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert len(rows) == 5 and {"id": 0} in rows


def test_topic_shapes(spark):
    df = spark.createDataFrame([("k", "v")], "key STRING, value STRING")
    assert topic_messages(df).dtypes == [("key", "string"), ("value", "string")]
    assert tuple(topic_messages(df).first()) == (None, "v")
    assert tuple(topic_messages(df, key="key").first()) == ("k", "v")
    with pytest.raises(ValueError):
        read_topics(spark, "broker:9092")
    with pytest.raises(ValueError):
        read_topics(spark, "broker:9092", ["a"], "a.*")
    stream = spark.readStream.format("rate").load().selectExpr("CAST(NULL AS STRING) AS key", "'x' AS value")
    with pytest.raises(ValueError):
        write_topic(stream, "broker:9092", "t")


def test_acks_by_topic_and_back(spark, folder):
    s = store(folder)
    s.write_batch(spark.createDataFrame([("billing", "k", 1, "x"), ("billing", None, 1, "x")], DOC), 0)
    out = ack_messages(s.log(spark))
    assert [tuple(r) for r in out.collect()] == [("billing_committed", None, "k")]
    received = out.select(
        "value", F.col("topic").alias("source"), F.current_timestamp().alias("arrived"), F.lit(5).alias("offset")
    )
    acks = topic_acks(received.unionByName(received.withColumn("source", F.lit("other"))))
    assert sorted((r["key"], r["source"], r["seq"]) for r in acks.collect()) == [("k", "billing", 5), ("k", "other", 5)]


def _docs(spark, n, second=0):
    ts = datetime(2024, 1, 1, 0, 0, second)
    return spark.range(n).select(F.lit("s").alias("source"), F.lit(ts).alias("ts"), F.col("id"))


@pytest.mark.parametrize("limit", [30, 1000])
def test_chunks_of_fifty(spark, limit):
    rows = chunk_summary(_docs(spark, 120), "ts", ["ts", "id"], max_group_rows=limit).orderBy("chunk").collect()
    assert [(r["n"], r["reason"]) for r in rows] == [(50, "count"), (50, "count"), (20, "timeout")]
    assert rows[2]["fire_ts"] == datetime(2024, 1, 1, 0, 0, 20)


def test_a_low_limit_does_not_cut_windows_into_countless_slices(spark):
    rows = _docs(spark, 3000)
    split = chunk_summary(rows, "ts", ["ts", "id"], max_group_rows=5)
    assert 2 <= len([f for f in split.inputFiles() if "/ranges-" in f]) <= 64
    plain = chunk_summary(rows, "ts", ["ts", "id"])
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))


def test_window_border_splits_a_chunk(spark):
    both = _docs(spark, 30, 19).unionByName(_docs(spark, 30, 20))
    rows = chunk_summary(both, "ts", ["ts", "id"]).collect()
    assert sorted((r["n"], r["reason"]) for r in rows) == [(30, "timeout"), (30, "timeout")]
    assert assign_chunks(both, "ts", ["ts", "id"]).where("chunk <> 0").count() == 0


def test_jobs_do_not_meet(spark, folder):
    s = store(folder)
    s.write_batch(spark.createDataFrame([("a", "k1", 1, "x")], DOC), 0, job="one")
    s.write_batch(spark.createDataFrame([("b", "k2", 1, "y")], DOC), 0, job="two")
    assert sorted(r["pcn"] for r in s.current(spark).collect()) == ["k1", "k2"]
    assert sorted((r["job"], r["key"]) for r in s.log(spark).collect()) == [("one", "k1"), ("two", "k2")]


def test_a_batch_is_replaced_as_a_whole(spark, folder):
    s = store(folder)
    s.write_batch(spark.createDataFrame([("a", "k1", 1, "x"), ("b", "k2", 1, "y"), ("b", None, 1, "z")], DOC), 0)
    s.write_batch(spark.createDataFrame([("a", "k1", 1, "x")], DOC), 0)
    assert s.documents(spark).count() == 1 and s.rejected(spark).count() == 0 and s.log(spark).count() == 1


def test_documents_keep_their_columns(spark, folder):
    s = store(folder)
    own = "source STRING, pcn STRING, v INT, status STRING, error STRING, batch_id STRING, job STRING"
    s.write_batch(spark.createDataFrame([("a", "k", 1, "PAID", "none", "b7", "j"), ("", "l", 1, "OPEN", None, None, None)], own), 0)
    s.write_batch(spark.createDataFrame([("a", "m", 1, "later")], "source STRING, pcn STRING, v INT, extra STRING"), 1)
    rows = {r["pcn"]: r for r in s.current(spark).collect()}
    assert (rows["k"]["status"], rows["k"]["error"], rows["k"]["batch_id"], rows["k"]["job"]) == ("PAID", "none", "b7", "j")
    assert rows["m"]["extra"] == "later" and rows["m"]["status"] is None
    assert s.rejected(spark).first()["status"] == "OPEN"
    assert {(r["key"], r["error"]) for r in s.log(spark).collect()} == {("k", None), ("l", "missing source"), ("m", None)}


def test_compaction_keeps_refused_documents_and_the_log(spark, folder):
    s = store(folder)
    s.write_batch(spark.createDataFrame([("a", "k", 1, "x"), ("a", None, 1, "lost")], DOC), 0)
    small = s.compact(spark, folder("compact"), 0)
    assert small.rejected(spark).first()["x"] == "lost" and small.log(spark).count() == 2


@pytest.mark.parametrize("limit", [15, 120])
def test_sessions_of_long_groups(spark, limit):
    """Sorting in ranges finds the sessions that one sorted group has."""
    rows = spark.range(600).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).when(F.col("id") % 2 == 0, F.lit("b")).alias("g"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(9000))).alias("ts"),
    )
    for groups in (["g"], []):
        whole = session_counts(rows, "ts", 20, groups)
        split = session_counts(rows, "ts", 20, groups, max_group_rows=limit)
        assert split.columns == whole.columns
        found = sorted(map(tuple, split.collect()), key=str)
        assert found == sorted(map(tuple, whole.collect()), key=str)
        assert sum(r[-1] for r in found) == 600
