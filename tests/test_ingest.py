import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jsonio import drop_nested_key, json_key, parse_typed, rows_to_json
from millrace.operators.ingest import ingest_counts, surrogate_keys, take_rows
from millrace.sources.delimited import good_rows, quarantined_rows, read_delimited, split_delimited
from millrace.spec import Registry, RunConfig, SourceSpec
from millrace.schemas import SCHEMAS, health_registry

HEADER = ["a", "b", "c"]


def _split(spark, lines, **options):
    return split_delimited(spark.createDataFrame([(x,) for x in lines], "value STRING"), HEADER, **options)


@pytest.mark.parametrize(
    "line, good",
    [
        ("1\tx\ty", ("1", "x", "y")),
        ("2\tb", None),  # too few
        ("3\tc\tz\textra", ("3", "c", "z")),  # too many: the rest is ignored
        ("4\td\t", None),  # an empty last column does not count
        ("5\t\tz", ("5", "", "z")),  # an empty middle column does
        ('6\tq"q\tw', ("6", 'q"q', "w")),
        ("7\té#,.\t�", ("7", "é#,.", "�")),
        ("8\tb\tc\t\t", ("8", "b", "c")),
        ("", None),
        ("\t\t\t", None),
    ],
)
def test_strict_columns(spark, line, good):
    split = _split(spark, [line])
    assert [tuple(r) for r in good_rows(split).collect()] == ([good] if good else [])
    assert [r["line"] for r in quarantined_rows(split).collect()] == ([] if good else [line])


def test_trailing_empty_as_null(spark):
    split = _split(spark, ["4\td\t", "5\te"], trailing_empty="null")
    assert [tuple(r) for r in good_rows(split).collect()] == [("4", "d", None)]
    assert quarantined_rows(split).count() == 1


def test_single_column_of_separators(spark):
    split = split_delimited(spark.createDataFrame([("\t",), ("",), ("x",)], "value STRING"), ["a"])
    assert sorted(r["a"] for r in good_rows(split).collect()) == ["", "x"]


def test_files_with_headers_and_crlf(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_bytes(f"k\tv\r\n{i}\tx\r\n{i}b\r\n{i}c\ty".encode())
    split = read_delimited(spark, str(tmp_path / "in"))
    assert sorted(r["k"] for r in good_rows(split).collect()) == ["0", "0c", "1", "1c", "2", "2c"]
    assert sorted(r["line"] for r in quarantined_rows(split).collect()) == ["0b", "1b", "2b"]
    counts = ingest_counts(split.withColumn("source", F.lit("s"))).first()
    assert (counts["good"], counts["malformed"]) == (6, 3)


def test_file_order_over_blocks(spark, tmp_path):
    (tmp_path / "f.txt").write_text("\n".join(["n\tx", *[f"{i}\tx" for i in range(3000)]]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = read_delimited(spark, str(tmp_path / "f.txt"), positions=True).withColumn("source", F.lit("s"))
        first = take_rows(lines, 50, ["_file", "_block", "_row"])
        assert sorted(int(r["n"]) for r in first.collect()) == list(range(50))
        many = take_rows(lines, 1500, ["_file", "_block", "_row"], max_group_rows=400)
        assert sorted(int(r["n"]) for r in many.collect()) == list(range(1500))
        for n, limit in ((20, 400), (1500, 400), (1500, 10_000)):
            whole = take_rows(lines, n, ["_file", "_block", "_row"], source=None, max_group_rows=limit)
            assert sorted(int(r["n"]) for r in whole.collect()) == list(range(n))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_to_json_escapes(spark):
    df = spark.createDataFrame([(7, 'q"q\\', None, "x\ty")], "k INT, a STRING, b STRING, c STRING")
    text = rows_to_json(df, ["a", "b", "c"], key=F.col("k")).first()["value"]
    assert json.loads(text) == {"pcn": "7", "a": 'q"q\\', "b": "", "c": "x\ty"}
    assert text.startswith('{"pcn":"7","a":')
    assert list(json.loads(rows_to_json(df, ["a"]).first()["value"])) == ["a"]


def test_json_key(spark):
    df = spark.createDataFrame([('{"pcn":"5"}',), ('{"x":1}',), ("junk",)], "value STRING")
    assert [r[0] for r in df.select(json_key("value")).collect()] == ["5", None, None]


SPEC = SourceSpec(
    "s",
    T.StructType(
        [
            T.StructField("pcn", T.StringType()),
            T.StructField("cost", T.LongType()),
            T.StructField("day", T.TimestampNTZType()),
        ]
    ),
)


@pytest.mark.parametrize(
    "text, cost, day, errors",
    [
        ('{"pcn":"1","cost":"67","day":"07-14-2015"}', 67, "2015-07-14 00:00:00", []),
        ('{"pcn":"1","cost":"67.0"}', 67, None, []),
        ('{"pcn":"1","cost":"67.5"}', None, None, ["cost"]),
        ('{"pcn":"1","cost":"","day":"45-75-2015"}', None, None, ["cost", "day"]),
        ('{"pcn":"1","cost":67}', 67, None, []),
    ],
)
def test_typed(spark, text, cost, day, errors):
    df = spark.createDataFrame([(text,)], "value STRING")
    row = parse_typed(df, SPEC).first()
    assert row["part"]["cost"] == cost
    assert (str(row["part"]["day"]) if row["part"]["day"] else None) == day
    assert row["_errors"] == errors
    strict = parse_typed(df, SPEC, strict=True).first()
    assert (strict["part"] is None) == bool(errors)


def test_typed_broken_text_and_absent_part(spark):
    texts = ["{broken", "", "5", "[1]", None]
    rows = parse_typed(spark.createDataFrame([(t,) for t in texts], "value STRING"), SPEC).collect()
    assert [(r["part"], r["_errors"]) for r in rows] == [(None, ["<json>"])] * 4 + [(None, [])]


def test_date_format_is_an_option(spark):
    spec = SourceSpec("s", SPEC.schema, date_format="yyyy/MM/dd")
    df = spark.createDataFrame([('{"day":"2015/07/14"}',)], "value STRING")
    assert str(parse_typed(df, spec).first()["part"]["day"]) == "2015-07-14 00:00:00"


def test_drop_nested_key_keeps_one(spark):
    df = spark.sql(
        "SELECT 1 AS pcn, named_struct('PCN', 1, 'x', 2, 'deep', named_struct('pcn', 1, 'y', 3)) AS p, "
        "array(named_struct('pcn', 1, 'z', 4)) AS q, CAST(NULL AS STRUCT<pcn: INT, w: INT>) AS r"
    )
    row = json.loads(drop_nested_key(df).toJSON().first())
    assert row == {"pcn": 1, "p": {"x": 2, "deep": {"y": 3}}, "q": [{"z": 4}]}


def test_surrogate_keys_are_dense_repeatable_and_mixed(spark):
    df = spark.range(500).selectExpr("id", "IF(id % 3 = 0, 'a', 'b') AS source")
    plain = surrogate_keys(df, ["id"]).collect()
    split = surrogate_keys(df, ["id"], max_group_rows=40).collect()
    assert {(r["id"], r["pcn"]) for r in plain} == {(r["id"], r["pcn"]) for r in split}
    for source in "ab":
        keys = [r["pcn"] for r in sorted(plain, key=lambda r: r["id"]) if r["source"] == source]
        assert sorted(keys) == list(range(len(keys)))
        assert keys != sorted(keys)


def test_surrogate_keys_under_a_low_limit_sample_few_slices(spark):
    df = spark.range(2000).selectExpr("id", "IF(id % 3 = 0, 'a', 'b') AS source")
    split = surrogate_keys(df, ["id"], max_group_rows=10)
    assert 2 <= len([f for f in split.inputFiles() if "/ranges-" in f]) <= 64
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, surrogate_keys(df, ["id"]).collect()))


def test_registry_text_and_config():
    reg = Registry.parse("t|treatment~b|billing_cost", SCHEMAS)
    assert reg.names == ["t", "b"] and reg["b"].schema == SCHEMAS["billing_cost"]
    same = Registry.parse("x|treatment~y|treatment", SCHEMAS)  # a schema may serve two sources
    assert same["x"].schema == same["y"].schema
    with pytest.raises(ValueError):
        Registry.parse("t|nothing", SCHEMAS)
    assert len(health_registry()) == 4
    config = RunConfig().override(chunk_rows=10, cluster="c")
    assert config.chunk_rows == 10 and config.extra == {"cluster": "c"}
    assert config.commit_topic("billing") == "billing_committed"


def test_a_line_like_the_header_is_data(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("x", "y"):
        (tmp_path / "in" / name).write_text("a\tb\n1\t2\na\tb\n3\t4\n")
    rows = good_rows(read_delimited(spark, str(tmp_path / "in"))).collect()
    assert sorted(map(tuple, rows)) == [("1", "2")] * 2 + [("3", "4")] * 2 + [("a", "b")] * 2


def test_separators_of_two_characters_and_dotted_names(spark):
    lines = spark.createDataFrame([("a:::",), ("a::b",), ("a::",)], "value STRING")
    split = split_delimited(lines, ["x.y", "z"], sep="::")
    assert sorted(map(tuple, good_rows(split).collect())) == [("a", ":"), ("a", "b")]
    from millrace.functions.jsonio import rows_to_json

    assert rows_to_json(good_rows(split), ["x.y"]).first()["value"] == '{"x.y":"a"}'


def test_large_whole_numbers_stay_exact(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from millrace.functions.jsonio import typed_value

    texts = ["9007199254740993.0", "9223372036854775808.0", "67.0", "67.5", "1e3", "-5.", "x", "1.0.0"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = {r["t"]: r["n"] for r in df.select("t", typed_value(F.col("t"), T.LongType(), "").alias("n")).collect()}
    assert got == dict(zip(texts, [9007199254740993, None, 67, None, 1000, -5, None, None]))


@pytest.mark.parametrize("limit", [10**9, 5_000, 700, 100])
def test_first_rows_at_any_limit(spark, limit):
    """The plain plan, salted pieces, and numbering over ranges give the same rows."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.lit("small")).alias("source"), "id")
    got = take_rows(df, 60, ["id"], max_group_rows=limit).collect()
    ids = {s: sorted(r["id"] for r in got if r["source"] == s) for s in ("hot", "small")}
    assert ids["small"] == list(range(0, 180, 3)) and ids["hot"] == [i for i in range(90) if i % 3]
    assert len(got) == 120
