"""The keyed store: upserts, commit log, write status, lookup load."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.catalog import query, table
from millrace.plans.data import LINE_VERSION, SQL_VERSION
from millrace.session import shared_dir
from millrace.sinks.lookup import load_lookup
from millrace.sinks.store import Store, write_status_counts
from millrace.sinks.text import ack_messages, topic_messages, write_json_text

BATCH_FLAGS = ["A", "N", "R"]
# A line of fifty pieces has lost its key.
SQL_LINES = """
    SELECT * REPLACE (CASE WHEN l_quantity <> 50 THEN l_orderkey END AS l_orderkey),
           CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS batch_id,
           l_linestatus AS source
    FROM lineitem
"""


def _stored_lines(spark, sf_dir, refreshed=0) -> Store:
    """Lines written in three batches, by return flag; the source is the line status. The current documents are refreshed after
    each of the first ``refreshed`` batches."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_quantity") != 50, F.col("l_orderkey")).alias("l_orderkey"),
        *LINE_VERSION,
        "l_returnflag",
        F.col("l_linestatus").alias("source"),
    )
    store = Store(shared_dir(spark, "store"), "l_orderkey", LINE_VERSION)
    for batch_id, flag in enumerate(BATCH_FLAGS):
        store.write_batch(lines.where(F.col("l_returnflag") == flag).drop("l_returnflag"), batch_id)
        if batch_id < refreshed:
            store.refresh(spark)
    return store


@query(
    f"""
    SELECT source, l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity,
           CAST(batch_id AS BIGINT) AS batch_id
    FROM ({SQL_LINES}) WHERE l_orderkey IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY source, l_orderkey ORDER BY {SQL_VERSION} DESC) = 1
    """
)
def upsert_sink_current(spark, sf_dir):
    return _stored_lines(spark, sf_dir).current(spark)


@query(
    f"""
    SELECT source, l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity
    FROM ({SQL_LINES}) WHERE l_orderkey IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY source, l_orderkey ORDER BY {SQL_VERSION} DESC) = 1
    """
)
def store_current_refreshed(spark, sf_dir):
    """The same from the store's current documents: refreshed after each of two batches, the third merged as it is read, and the
    history of the first two removed."""
    store = _stored_lines(spark, sf_dir, refreshed=2)
    store.prune(spark, older_than_seconds=0)
    return store.current(spark).drop("batch_id")


@query(
    f"""
    SELECT source, l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity
    FROM ({SQL_LINES}) WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
    QUALIFY row_number() OVER (PARTITION BY source, l_orderkey ORDER BY {SQL_VERSION} DESC) = 1
    """
)
def store_fetch_by_keys(spark, sf_dir):
    """Current lines of urgent orders, fetched by key from the store."""
    store = _stored_lines(spark, sf_dir, refreshed=2)
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    return store.fetch(spark, urgent).drop("batch_id")


@query(
    f"""
    SELECT CAST(batch_id AS BIGINT) AS batch_id, source, l_orderkey AS key,
           CASE WHEN l_orderkey IS NULL THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN l_orderkey IS NULL THEN 'missing key' END AS error
    FROM ({SQL_LINES})
    """
)
def commit_log(spark, sf_dir):
    return _stored_lines(spark, sf_dir).log(spark).select("batch_id", "source", "key", "status", "error")


@query(
    f"""
    SELECT CAST(batch_id AS BIGINT) AS batch_id, source,
           COUNT(l_orderkey) AS succeeded, COUNT(*) - COUNT(l_orderkey) AS failed
    FROM ({SQL_LINES}) GROUP BY 1, 2
    """
)
def write_status(spark, sf_dir):
    return write_status_counts(_stored_lines(spark, sf_dir).log(spark))


@query(
    f"""
    SELECT source || '_committed' AS topic, CAST(NULL AS VARCHAR) AS key, CAST(l_orderkey AS VARCHAR) AS value
    FROM ({SQL_LINES}) WHERE l_orderkey IS NOT NULL
    """,
    name="ack_messages",
)
def ack_messages_query(spark, sf_dir):
    return ack_messages(_stored_lines(spark, sf_dir).log(spark))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def lookup_load(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    # Loaded twice over: the second copy must not show.
    return load_lookup(customers.unionAll(customers), shared_dir(spark, "lookup"), "c_custkey")


SQL_ORDER_JSON = """
    '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"'
    || o_orderpriority || '"}'
"""


def _order_cards(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(f"SELECT {SQL_ORDER_JSON} AS value FROM orders")
def json_text_sink(spark, sf_dir):
    path = shared_dir(spark, "json")
    write_json_text(_order_cards(spark, sf_dir), path)
    return spark.read.text(path)


@query(f"SELECT CAST(NULL AS VARCHAR) AS key, {SQL_ORDER_JSON} AS value FROM orders", name="topic_messages")
def topic_messages_query(spark, sf_dir):
    """What a topic would be sent; there is no broker here."""
    orders = _order_cards(spark, sf_dir)
    return topic_messages(orders.select(F.to_json(F.struct(*orders.columns)).alias("value")))
