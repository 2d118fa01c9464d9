from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.jsonio import part_json
from millrace.operators.enrich import Part, assemble, enrich_nway, lookup_join, rejected_rows
from millrace.operators.latest import latest_per_key, lookup_by_keys
from millrace.operators.skew import fits_broadcast, hot_groups, join_unique, ordered_position


def part(spark, name, rows):
    return Part(name, spark.createDataFrame(rows, "pcn STRING, v INT, x STRING"), "pcn", ["v"], ["x"])


def test_newest_version_wins_in_any_order(spark):
    rows = [("k", 1, "old"), ("k", 3, "new"), ("k", 2, "mid"), ("j", 1, "only"), (None, 5, "n"), ("i", None, "n")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "pcn STRING, v INT, x STRING").repartition(3)
        got = {r["pcn"]: r["x"] for r in latest_per_key(df, ["pcn"], ["v"]).collect()}
        assert got == {"k": "new", "j": "only"}


def test_absent_part_is_null_and_named(spark):
    a = part(spark, "a", [("k", 1, "xa"), ("j", 1, "xj")])
    b = part(spark, "b", [("j", 1, "yj")])
    gate = spark.createDataFrame([("k",), ("j",), ("ghost",)], "key STRING")
    rows = {r["key"]: r for r in enrich_nway([a, b], gate=gate).collect()}
    assert rows["k"]["b"] is None and rows["k"]["missing_parts"] == ["b"]
    assert rows["j"]["a"]["x"] == "xj" and rows["j"]["missing_parts"] == []
    assert rows["ghost"]["missing_parts"] == ["a", "b"]
    assert [r["key"] for r in enrich_nway([a, b]).collect()] == ["j"]


def test_unusable_rows_are_kept_apart(spark):
    a = part(spark, "a", [("k", 1, "x"), (None, 1, "y"), ("k", None, "z")])
    assert sorted((r["x"], r["reason"]) for r in rejected_rows(a).collect()) == [
        ("y", "missing key"),
        ("z", "missing version"),
    ]


def test_as_of_completion_ignores_later_versions(spark):
    a = part(spark, "a", [("k", 1, "a1"), ("k", 9, "a9")])
    b = part(spark, "b", [("k", 5, "b5")])
    assert enrich_nway([a, b]).first()["a"]["x"] == "a9"
    assert enrich_nway([a, b], as_of="completion").first()["a"]["x"] == "a1"


def test_sources_in_one_table(spark):
    df = spark.createDataFrame(
        [("k", 1, "xa", "a"), ("k", 2, "xb", "b"), ("k", 9, "late", "a"), ("j", 1, "y", "a"), ("k", 1, "z", "zz")],
        "pcn STRING, v INT, x STRING, s STRING",
    )
    both = [Part(n, df, "pcn", ["v"], ["x"], F.col("s") == n) for n in "ab"]
    for as_of, a in (("latest", "late"), ("completion", "xa")):
        rows = enrich_nway(both, as_of=as_of).collect()
        assert [(r["key"], r["a"]["x"], r["b"]["x"]) for r in rows] == [("k", a, "xb")]


def test_lookup_miss_and_duplicate(spark):
    df = spark.createDataFrame([(1, "p"), (2, "q"), (3, None)], "id INT, pid STRING")
    dim = spark.createDataFrame([("p", 1, "old"), ("p", 2, "new"), ("z", 1, "z")], "patientID STRING, v INT, n STRING")
    rows = {r["id"]: r["patientInfo"] for r in lookup_join(df, dim, "pid", "patientID", "patientInfo", ["v"]).collect()}
    assert rows[1]["n"] == "new" and rows[2] is None and rows[3] is None
    assert lookup_join(df, dim, "pid", "patientID", "p").count() == 3


def test_lookup_through_a_missing_part(spark):
    df = spark.sql("SELECT 1 AS id, CAST(NULL AS STRUCT<patientID: STRING>) AS billing")
    dim = spark.createDataFrame([("p", "n")], "patientID STRING, n STRING")
    assert lookup_join(df, dim, "billing.patientID", "patientID", "p").first()["p"] is None


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_skewed_join_equals_plain_join(spark, how):
    left = spark.range(600).selectExpr("id", "IF(id % 3 = 0, 7, IF(id % 50 = 1, NULL, id % 40)) AS k")
    right = spark.range(30).selectExpr("id AS rk", "id * 10 AS v")
    plain = sorted(map(repr, left.join(right, left.k == right.rk, how).collect()))
    skewed = join_unique(left, right, {"k": "rk"}, how, max_group_rows=20, broadcast_rows=0)
    assert sorted(map(repr, skewed.collect())) == plain
    assert sorted(map(repr, join_unique(left, right, {"k": "rk"}, how).collect())) == plain


def test_positions_with_null_groups_and_hot_groups(spark):
    df = spark.range(400).selectExpr("id", "IF(id % 2 = 0, NULL, id % 5) AS g", "id % 11 AS o")
    for limit in (15, 60, 10_000):
        rows = ordered_position(df, ["g"], ["o", "id"], max_group_rows=limit).collect()
        groups = {}
        for r in rows:
            groups.setdefault(r["g"], []).append(r)
        assert len(rows) == 400
        for members in groups.values():
            members.sort(key=lambda r: (r["o"], r["id"]))
            assert [r["position"] for r in members] == list(range(1, len(members) + 1))


def test_hot_groups_and_size_check(spark):
    df = spark.range(100).selectExpr("id", "IF(id < 60, 0, id) AS k")
    assert hot_groups(df, ["k"], 60) is None
    hot = hot_groups(df, ["k"], 59)
    assert (hot.count, hot.rows, hot.everything) == (1, 60, False)
    assert hot_groups(df.where("k = 0"), ["k"], 59).everything
    assert fits_broadcast(df, max_rows=100) and not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=1000)
    assert fits_broadcast(df.limit(0), max_bytes=0)
    assert not fits_broadcast(spark.range(3).selectExpr("repeat('x', 1000) AS s"), max_bytes=2000)


def test_lookup_by_keys_returns_one_document_per_key(spark):
    docs = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c")], "pcn STRING, v INT, x STRING")
    wanted = spark.createDataFrame([("k",), ("k",), ("nope",)], "pcn STRING")
    assert [tuple(r) for r in lookup_by_keys(docs, wanted, "pcn", ["v"]).collect()] == [("k", 2, "b")]


def test_record_has_the_key_once_at_the_top(spark):
    df = spark.sql(
        "SELECT 'k' AS key, named_struct('pcn', 'k', 'cost', 5) AS billing_cost, "
        "CAST(NULL AS STRUCT<pcn: STRING, icd: STRING>) AS treatment"
    )
    record = assemble(df, "key", {"billing_cost": "billingCost", "treatment": "treatment"}, "pcn")
    assert record.select(part_json(record).alias("j")).first()["j"] == '{"pcn":"k","billingCost":{"cost":5}}'


def test_two_sources_with_one_schema(spark):
    a, b = part(spark, "home", [("k", 1, "h")]), part(spark, "work", [("k", 1, "w")])
    row = assemble(enrich_nway([a, b]), "key", {"home": "home", "work": "work"}).first()
    assert (row["home"]["x"], row["work"]["x"]) == ("h", "w")


def test_version_columns_of_several_types(spark):
    df = spark.createDataFrame(
        [("k", datetime(2024, 1, 1), 2, "b"), ("k", datetime(2024, 1, 1), 10, "c"), ("k", datetime(2023, 1, 1), 99, "a")],
        "pcn STRING, ts TIMESTAMP, n INT, x STRING",
    )
    assert latest_per_key(df, ["pcn"], ["ts", "n"]).select(F.max("x")).first()[0] == "c"


ROW = st.tuples(st.sampled_from("ijk"), st.sampled_from("ab"), st.integers(0, 5), st.sampled_from("xyz"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=20), st.randoms())
def test_enrichment_does_not_depend_on_order(spark, rows, random):
    newest = {}
    for k, s, v, x in rows:
        newest[k, s] = max(newest.get((k, s), (v, x)), (v, x))
    wanted = sorted(
        (k, newest[k, "a"][1], newest[k, "b"][1]) for k in "ijk" if (k, "a") in newest and (k, "b") in newest
    )
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "pcn STRING, s STRING, v INT, x STRING").repartition(3)
    both = [Part(n, df, "pcn", ["v"], ["x"], F.col("s") == n) for n in "ab"]
    assert sorted((r["key"], r["a"]["x"], r["b"]["x"]) for r in enrich_nway(both).collect()) == wanted


def test_a_large_lookup_after_an_aggregate(spark):
    df = spark.range(300).selectExpr("CAST(id AS STRING) AS pcn", "1 AS v", "IF(id % 3 = 0, 'p0', concat('p', id)) AS pid")
    records = enrich_nway([Part("billing", df, "pcn", ["v"], ["pid"])])
    dim = spark.range(200).selectExpr("concat('p', id) AS patientID", "id AS n")
    limits = {"max_group_rows": 50, "broadcast_rows": 0}
    split = lookup_join(records, dim, "billing.pid", "patientID", "patient", **limits)
    plain = lookup_join(records, dim, "billing.pid", "patientID", "patient")
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))
    assert split.where("patient.n = 0").count() == 100
