"""The physical plans we rely on at scale."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from millrace.operators.enrich import enrich_nway
from millrace.operators.gate import gate_count, gate_distinct
from millrace.operators.latest import latest_per_key
from millrace.plans import QUERIES
from millrace.plans.catalog import table
from millrace.plans.data import EVENT_TYPES, LINE_VERSION, acks, parts


SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffles(df):
    return len(re.findall(r"^\(\d+\) Exchange", plan(df), re.M))


def test_enrich_is_one_shuffle(spark):
    assert shuffles(enrich_nway(parts(spark, SF))) == 1


def test_gate_is_one_shuffle_in_codegen(spark):
    df = gate_distinct(acks(spark, SF), EVENT_TYPES)
    text = plan(df)
    assert shuffles(df) == 1 and "SortAggregate" not in text
    assert "partial_min" in text and "partial_count" in text


def test_count_gate_limits_before_the_shuffle(spark):
    text = plan(gate_count(acks(spark, SF), 4))
    assert text.count("WindowGroupLimit") >= 2


def test_latest_is_combined_before_the_shuffle(spark):
    df = latest_per_key(table(spark, SF, "lineitem"), ["l_orderkey"], LINE_VERSION)
    assert shuffles(df) == 1 and "partial_max" in plan(df)


def test_small_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["lookup_join"](spark, SF))


def test_columns_and_filters_reach_the_scan(spark):
    text = plan(enrich_nway(parts(spark, SF)))
    assert "l_tax" not in text and "l_discount" not in text
    assert "Or(" in text and "EqualTo(l_returnflag,A)" in text


def test_a_shared_table_is_scanned_once(spark):
    text = plan(enrich_nway(parts(spark, SF)))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 2


SINGLE = {"probe_cost"}  # one row over all keys, already combined


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_batch_plan_is_distributed_and_jvm_only(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "SinglePartition" not in text or name in SINGLE
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Python|Pandas|InArrow", text)


def test_sizes_are_checked_before_a_broadcast(spark):
    from millrace.operators.skew import join_unique

    left = spark.range(100).withColumn("k", F.col("id"))
    right = spark.range(50).select(F.col("id").alias("rk"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(join_unique(left, right, {"k": "rk"}))
        assert "BroadcastHashJoin" not in plan(join_unique(left, right, {"k": "rk"}, broadcast_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_filters_before_it_aggregates(spark):
    from millrace.operators.latest import lookup_by_keys

    lines = table(spark, SF, "lineitem")
    wanted = table(spark, SF, "orders").limit(50).select(F.col("o_orderkey").alias("l_orderkey"))
    text = lookup_by_keys(lines, wanted, "l_orderkey", LINE_VERSION)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Aggregate [l_orderkey") < text.index("Join LeftSemi")


def test_sessions_do_not_follow_the_zone(spark):
    from millrace.operators.batching import session_counts

    times = spark.sql("SELECT 'g' AS g, TIMESTAMP_NTZ'2024-03-10 01:30:00' AS ts UNION ALL SELECT 'g', TIMESTAMP_NTZ'2024-03-10 03:30:00'")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert session_counts(times, "ts", 90 * 60, ["g"]).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
