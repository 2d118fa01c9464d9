import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators.gate import (
    gate_count,
    gate_distinct,
    incomplete_keys,
    rejected_acks,
    running_count,
    source_progress,
)
from millrace.streaming.gate import gate_stream
from millrace.streaming.jobs import run_available

T0 = datetime(2024, 1, 1)
SCHEMA = "key STRING, source STRING, commit_ts TIMESTAMP, seq BIGINT, status STRING"


def acks(spark, text, status=None):
    """'k:a' arrivals in order, one second apart."""
    rows = []
    for i, pair in enumerate(text.split()):
        key, source = pair.split(":")
        rows.append((key, source, T0 + timedelta(seconds=i), i, (status or {}).get(i, "ok")))
    return spark.createDataFrame(rows, SCHEMA)


def keys(df):
    return sorted(r["key"] for r in df.collect())


def test_duplicate_ack(spark):
    df = acks(spark, "k:a k:a k:b k:c")
    assert keys(gate_distinct(df, ["a", "b", "c", "d"])) == []
    assert [r["seq"] for r in gate_count(df, 4).collect()] == [3]  # counting does not tell sources apart


def test_ack_after_completion_emits_once(spark):
    df = acks(spark, "k:a k:b k:c k:d k:a")
    row = gate_distinct(df, ["a", "b", "c", "d"]).collect()
    assert [(r["completed_by"], r["completed_ts"]) for r in row] == [("d", T0 + timedelta(seconds=3))]
    assert len(gate_count(df, 4).collect()) == 1


def test_missing_source_is_reported(spark):
    row = incomplete_keys(acks(spark, "k:a k:b k:c j:a j:b j:c j:d"), ["a", "b", "c", "d"]).collect()
    assert [(r["key"], r["missing"]) for r in row] == [("k", ["d"])]


def test_failed_write_does_not_count(spark):
    df = acks(spark, "k:a k:b j:a j:b", status={1: "failed"})
    assert keys(gate_distinct(df, ["a", "b"])) == ["j"]
    assert [r["reason"] for r in rejected_acks(df, ["a", "b"]).collect()] == ["write failed"]


def test_unknown_source_and_missing_key_are_kept_apart(spark):
    df = acks(spark, "k:a k:b k:zz").unionByName(
        spark.createDataFrame([(None, "a", T0, 9, "ok"), ("k", "a", None, 10, "ok")], SCHEMA)
    )
    assert keys(gate_distinct(df, ["a", "b"])) == ["k"]
    reasons = sorted(r["reason"] for r in rejected_acks(df, ["a", "b"]).collect())
    assert reasons == ["missing key", "missing time", "unknown source"]


def test_single_source(spark):
    assert keys(gate_distinct(acks(spark, "k:a j:a"), ["a"])) == ["j", "k"]


def test_more_sources_than_mask_bits(spark):
    names = [f"s{i}" for i in range(70)]
    df = acks(spark, " ".join(f"k:{n}" for n in names) + " " + " ".join(f"j:{n}" for n in names[:-1]))
    row = gate_distinct(df, names).collect()
    assert [(r["key"], r["completed_by"], r["arrivals"]) for r in row] == [("k", "s69", 70)]
    assert [r["missing"] for r in incomplete_keys(df, names).collect()] == [["s69"]]


@pytest.mark.parametrize("number", [5, 200])
def test_any_number_of_sources_takes_one_plan(spark, folder, number):
    """Ties in time go to the source declared first; the batch form and the stream agree with a calculation by hand."""
    names = [f"s{(7 * i) % number}" for i in range(number)]
    rng = random.Random(number)
    rows = []
    for key in "hijk":
        for name in names if key != "h" else names[1:]:
            for _ in range(rng.randint(1, 3)):
                rows.append((key, name, T0 + timedelta(seconds=rng.randint(0, number // 3)), len(rows), "ok"))
    rng.shuffle(rows)
    first = {}
    for key, name, ts, _, _ in rows:
        first[key, name] = min(ts, first.get((key, name), ts))
    expected = {}
    for key in "ijk":
        last = max(first[key, n] for n in names)
        expected[key] = (sum(r[0] == key for r in rows), last, next(n for n in names if first[key, n] == last))
    df = spark.createDataFrame(rows, SCHEMA)
    progress = source_progress(df, names)
    assert progress._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {r["key"]: (r["arrivals"], r["completed_ts"], r["completed_by"]) for r in gate_distinct(df, names).collect()} == expected
    assert [(r["key"], r["missing"]) for r in incomplete_keys(df, names).collect()] == [("h", [names[0]])]
    path = folder("acks")
    df.coalesce(1).write.parquet(path)
    done = run_available(gate_stream(spark.readStream.schema(SCHEMA).parquet(path), names), "gate", "update")
    assert {r["key"]: (r["arrivals"], r["completed_ts"], r["completed_by"]) for r in done.collect()} == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ijk"), st.sampled_from("abc")), min_size=1, max_size=25), st.randoms())
def test_order_of_rows_does_not_matter(spark, arrivals, random):
    rows = [(k, s, T0 + timedelta(seconds=i), i, "ok") for i, (k, s) in enumerate(arrivals)]
    expected = {}
    for k, s, ts, _, _ in rows:
        expected.setdefault(k, {}).setdefault(s, ts)
    wanted = sorted((k, max(v.values())) for k, v in expected.items() if len(v) == 3)
    random.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((r["key"], r["completed_ts"]) for r in gate_distinct(df, list("abc")).collect())
    assert got == wanted


@pytest.mark.parametrize("limit", [3, 10, 1000])
def test_running_count_with_a_hot_key(spark, limit):
    rows = [("hot" if i % 3 else f"k{i % 7}", "a", T0 + timedelta(seconds=i // 2), i, "ok") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    seen, wanted = {}, {}
    for key, _, _, seq, _ in rows:
        seen[key] = seen.get(key, 0) + 1
        wanted[seq] = seen[key]
    got = {r["seq"]: r["running"] for r in running_count(df, max_group_rows=limit).collect()}
    assert got == wanted


def test_progress_names_sources_as_declared(spark):
    """Ties in time, and names that are not declared in order."""
    from datetime import datetime

    from millrace.operators import gate

    sources = ["zeta", "alpha", "mid"]
    at = [datetime(2024, 1, 1, 0, 0, s) for s in range(3)]
    rows = [("k", "alpha", at[1], 1), ("k", "zeta", at[1], 2), ("k", "mid", at[0], 3), ("j", "alpha", at[2], 4), ("j", "zeta", at[2], 5)]
    acks = spark.createDataFrame(rows, "key STRING, source STRING, commit_ts TIMESTAMP, seq INT")
    few = sorted(map(tuple, gate.source_progress(acks, sources).collect()))
    assert {r[0]: (r[2], r[5]) for r in few} == {"k": (sources, "zeta"), "j": (["zeta", "alpha"], None)}
