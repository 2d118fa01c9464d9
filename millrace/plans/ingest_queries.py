"""Delimited input, JSON conversion, row budgets and surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jsonio import drop_nested_key, json_key, parse_typed, rows_to_json
from millrace.operators.ingest import ingest_counts, surrogate_keys, take_rows
from millrace.plans.catalog import query, table
from millrace.plans.data import ORDER_HEADER, SQL_ORDER_CELLS, order_lines
from millrace.session import shared_dir
from millrace.sources.delimited import good_rows, quarantined_rows, read_delimited, split_delimited
from millrace.sources.streams import union_sources
from millrace.spec import SourceSpec


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, c_mktsegment
    FROM customer
    """,
    name="read_delimited",
)
def read_delimited_query(spark, sf_dir):
    path = shared_dir(spark, "customers-tsv")
    customers = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    customers.write.options(header=True, sep="\t", quote="", emptyValue="", nullValue="").csv(path)
    return good_rows(read_delimited(spark, path, customers.columns))


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, CAST(o_custkey AS VARCHAR) AS custkey,
           o_orderstatus AS status, strftime(o_orderdate, '%m-%d-%Y') AS orderdate,
           o_orderpriority AS priority
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
    """
)
def quarantine_good(spark, sf_dir):
    return good_rows(split_delimited(order_lines(spark, sf_dir).select("value"), ORDER_HEADER))


@query(
    f"""
    SELECT o_orderstatus AS source,
           CASE WHEN o_orderstatus = 'P' THEN {SQL_ORDER_CELLS} ELSE {SQL_ORDER_CELLS} || chr(9) END AS line
    FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'
    """
)
def quarantine_bad(spark, sf_dir):
    return quarantined_rows(split_delimited(order_lines(spark, sf_dir), ORDER_HEADER), ["source"])


SQL_INGEST_COUNTS = """
    SELECT o_orderstatus AS source,
           COUNT(*) FILTER (WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW') AS good,
           COUNT(*) FILTER (WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW') AS malformed
    FROM orders GROUP BY 1
"""


@query(SQL_INGEST_COUNTS, name="ingest_counts")
def ingest_counts_query(spark, sf_dir):
    return ingest_counts(split_delimited(order_lines(spark, sf_dir), ORDER_HEADER))


@query(
    """
    SELECT CAST(json_object('pcn', CAST(doc_id AS VARCHAR), 'lang', lang, 'source', source,
                            'n_chars', CAST(n_chars AS VARCHAR), 'text', text) AS VARCHAR) AS value
    FROM documents
    """,
    name="rows_to_json",
)
def rows_to_json_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return rows_to_json(docs, ["lang", "source", "n_chars", "text"], key=F.col("doc_id"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events", name="json_key")
def json_key_query(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", json_key("props", "k").alias("k"))


WIRE = SourceSpec(
    "billing",
    T.StructType(
        [
            T.StructField("pcn", T.StringType()),
            T.StructField("patientID", T.StringType()),
            T.StructField("totalCost", T.LongType()),
            T.StructField("age", T.IntegerType()),
            T.StructField("visitDate", T.TimestampNTZType()),
        ]
    ),
)


def _messages(spark, sf_dir):
    """Orders as wire messages: everything quoted, some costs with a fraction, some dates unreadable."""
    orders = table(spark, sf_dir, "orders")
    whole = F.floor("o_totalprice").cast("string")
    message = orders.select(
        F.col("o_orderkey").alias("pcn"),
        F.col("o_custkey").alias("patientID"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(whole, F.lit(".5")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(whole, F.lit(".0")))
        .otherwise(whole)
        .alias("totalCost"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("99999999999"))
        .otherwise(F.substring("o_orderpriority", 1, 1))
        .alias("age"),
        F.when(F.col("o_orderstatus") == "P", F.lit("pending"))
        .otherwise(F.date_format("o_orderdate", "MM-dd-yyyy"))
        .alias("visitDate"),
    )
    return rows_to_json(message, message.columns)


def _bound(messages, strict):
    typed = parse_typed(messages, WIRE, strict=strict)
    return typed.select("part.*", F.concat_ws(",", "_errors").alias("errors"))


SQL_TYPED = """
    SELECT CAST(o_orderkey AS VARCHAR) AS pcn, CAST(o_custkey AS VARCHAR) AS "patientID",
           CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(floor(o_totalprice) AS BIGINT) END AS "totalCost",
           CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS age,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS "visitDate",
           concat_ws(',', CASE WHEN o_orderpriority = '1-URGENT' THEN 'totalCost' END,
                          CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'age' END,
                          CASE WHEN o_orderstatus = 'P' THEN 'visitDate' END) AS errors
    FROM orders
"""


@query(SQL_TYPED)
def json_to_typed(spark, sf_dir):
    return _bound(_messages(spark, sf_dir), strict=False)


@query(
    f"""
    SELECT CASE WHEN errors = '' THEN pcn END AS pcn, CASE WHEN errors = '' THEN "patientID" END AS "patientID",
           CASE WHEN errors = '' THEN "totalCost" END AS "totalCost", CASE WHEN errors = '' THEN age END AS age,
           CASE WHEN errors = '' THEN "visitDate" END AS "visitDate", errors
    FROM ({SQL_TYPED})
    """
)
def json_to_typed_strict(spark, sf_dir):
    return _bound(_messages(spark, sf_dir), strict=True)


@query(
    """
    SELECT o_orderkey AS pcn,
           '{"custkey":' || o_custkey || ',"detail":{"priority":"' || o_orderpriority || '"}}' AS billing
    FROM orders
    """,
    name="drop_nested_key",
)
def drop_nested_key_query(spark, sf_dir):
    detail = F.struct(F.col("o_orderkey").alias("Pcn"), F.col("o_orderpriority").alias("priority"))
    nested = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pcn"),
        F.struct(F.col("o_orderkey").alias("PCN"), F.col("o_custkey").alias("custkey"), detail.alias("detail")).alias(
            "billing"
        ),
    )
    return drop_nested_key(nested).select("pcn", F.to_json("billing").alias("billing"))


@query(
    """
    SELECT 'billing' AS source, o_orderkey AS key, o_orderdate AS version FROM orders
    UNION ALL
    SELECT 'line' AS source, l_orderkey AS key, l_shipdate AS version FROM lineitem
    """,
    name="union_sources",
)
def union_sources_query(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return union_sources(
        {
            "billing": orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("version")),
            "line": lines.select(F.col("l_orderkey").alias("key"), F.col("l_shipdate").alias("version")),
        }
    )


@query(
    """
    SELECT event_type AS source, event_id, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 337
    """,
    name="take_rows",
)
def take_rows_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), "event_id", "ts")
    return take_rows(events, 337, ["ts", "event_id"])


def _keyed(spark, sf_dir, **limits):
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), "event_id")
    return surrogate_keys(events, ["event_id"], **limits)


SQL_SURROGATE = """
    SELECT event_type AS source, event_id,
           row_number() OVER (PARTITION BY event_type
                              ORDER BY md5('42|' || event_type || '|' || event_id), event_id) - 1 AS pcn
    FROM events
"""


@query(SQL_SURROGATE, name="surrogate_keys")
def surrogate_keys_query(spark, sf_dir):
    return _keyed(spark, sf_dir)


@query(SQL_SURROGATE)
def surrogate_keys_split(spark, sf_dir):
    """The same with every source treated as too large for one task."""
    return _keyed(spark, sf_dir, max_group_rows=1500)
