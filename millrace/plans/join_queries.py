"""Newest versions, gated N-way joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.jsonio import part_json
from millrace.operators.enrich import assemble, enrich_nway, lookup_join
from millrace.operators.latest import latest_per_key, lookup_by_keys
from millrace.plans.catalog import query, table
from millrace.plans.data import FLAGS, LINE_VERSION, SQL_VERSION, parts

LINE_OUT = {"l_partkey": "partkey", "l_extendedprice": "price", "l_linestatus": "status"}
SQL_FLAG_COLUMNS = ", ".join(
    f"{name}.{column} AS {name}_{alias}" for name in FLAGS for column, alias in LINE_OUT.items()
)


def _sql_newest(flag: str, where: str = "") -> str:
    return f"""(SELECT * FROM lineitem WHERE l_returnflag = '{flag}' {where}
                QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {SQL_VERSION} DESC) = 1)"""


SQL_ENRICHED = f"""
    SELECT o_orderkey AS key, o_custkey, o_totalprice, {SQL_FLAG_COLUMNS}, c_name, c_mktsegment
    FROM orders
    {" ".join(f"JOIN {_sql_newest(f)} {n} ON {n}.l_orderkey = o_orderkey" for n, f in FLAGS.items())}
    LEFT JOIN customer ON c_custkey = o_custkey
"""


def _flag_columns():
    return [F.col(f"{n}.{c}").alias(f"{n}_{a}") for n in FLAGS for c, a in LINE_OUT.items()]


def _with_customer(records, spark, sf_dir, **limits):
    return lookup_join(
        records, table(spark, sf_dir, "customer"), "billing.o_custkey", "c_custkey", "customer", **limits
    )


@query(SQL_ENRICHED, name="enrich_nway")
def enrich_nway_query(spark, sf_dir):
    records = _with_customer(enrich_nway(parts(spark, sf_dir)), spark, sf_dir)
    return records.select(
        "key",
        "billing.o_custkey",
        "billing.o_totalprice",
        *_flag_columns(),
        "customer.c_name",
        "customer.c_mktsegment",
    )


@query(
    f"""
    WITH firsts AS (
        SELECT l_orderkey, COUNT(DISTINCT l_returnflag) AS flags,
               MAX(first_seen) AS last_first_seen
        FROM (SELECT l_orderkey, l_returnflag,
                     MIN(l_shipdate) OVER (PARTITION BY l_orderkey, l_returnflag) AS first_seen FROM lineitem)
        GROUP BY l_orderkey HAVING COUNT(DISTINCT l_returnflag) = 3),
    done AS (SELECT o.*, greatest(last_first_seen, o_orderdate) AS done_ts
             FROM orders o JOIN firsts ON l_orderkey = o_orderkey)
    SELECT o_orderkey AS key, o_custkey, o_totalprice, {SQL_FLAG_COLUMNS}
    FROM done
    {" ".join(f'''JOIN (SELECT l.* FROM lineitem l JOIN done ON l_orderkey = o_orderkey
                        WHERE l_returnflag = '{f}' AND l_shipdate <= done_ts
                        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {SQL_VERSION} DESC) = 1) {n}
                  ON {n}.l_orderkey = o_orderkey''' for n, f in FLAGS.items())}
    """
)
def enrich_as_of_completion(spark, sf_dir):
    records = enrich_nway(parts(spark, sf_dir), as_of="completion", stored=True)
    return records.select("key", "billing.o_custkey", "billing.o_totalprice", *_flag_columns())


@query(
    f"""
    SELECT o_orderkey AS key, {SQL_FLAG_COLUMNS},
           concat_ws(',', {", ".join(f"CASE WHEN {n}.l_orderkey IS NULL THEN '{n}' END" for n in FLAGS)}) AS missing
    FROM orders
    {" ".join(f"LEFT JOIN {_sql_newest(f)} {n} ON {n}.l_orderkey = o_orderkey" for n, f in FLAGS.items())}
    """
)
def enrich_missing_parts(spark, sf_dir):
    """Keys declared complete by someone else: parts that are not there stay null."""
    gate = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    lines = [p for p in parts(spark, sf_dir) if p.name in FLAGS]
    records = enrich_nway(lines, gate=gate)
    return records.select("key", *_flag_columns(), F.array_join("missing_parts", ",").alias("missing"))


def _sql_line_json(n: str) -> str:
    return (
        f"""'"{n}":{{"l_partkey":' || {n}.l_partkey || ',"l_suppkey":' || {n}.l_suppkey """
        f"""|| ',"l_linenumber":' || {n}.l_linenumber || ',"l_linestatus":"' || {n}.l_linestatus || '"}}'"""
    )


@query(
    f"""
    SELECT '{{"pcn":' || o_orderkey
           || ',"patientInfo":{{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"'
           || c_mktsegment || '"}},"billingCost":{{"o_custkey":' || o_custkey || ',"o_orderpriority":"'
           || o_orderpriority || '"}},' || {" || ',' || ".join(_sql_line_json(n) for n in FLAGS)} || '}}' AS value
    FROM orders
    {" ".join(f"JOIN {_sql_newest(f)} {n} ON {n}.l_orderkey = o_orderkey" for n, f in FLAGS.items())}
    JOIN customer ON c_custkey = o_custkey
    """
)
def enriched_json(spark, sf_dir):
    inputs = parts(spark, sf_dir)
    for p in inputs:
        p.fields = [f for f in p.fields if f not in ("o_totalprice", "l_extendedprice")]
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    records = lookup_join(enrich_nway(inputs), customers, "billing.o_custkey", "c_custkey", "patient_info")
    fields = {"patient_info": "patientInfo", "billing": "billingCost", **{n: n for n in FLAGS}}
    record = assemble(records, "key", fields, key_name="pcn")
    return record.select(part_json(record).alias("value"))


@query(
    f"""
    SELECT l_orderkey, l_returnflag, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY {SQL_VERSION} DESC) = 1
    """,
    name="latest_per_key",
)
def latest_per_key_query(spark, sf_dir):
    return latest_per_key(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_returnflag"],
        LINE_VERSION,
        [*LINE_VERSION, "l_extendedprice"],
    )


@query(
    f"""
    SELECT * FROM (SELECT l_orderkey, l_returnflag, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity
                   FROM lineitem
                   QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {SQL_VERSION} DESC) = 1)
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
    """,
    name="lookup_by_keys",
)
def lookup_by_keys_query(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    docs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", *LINE_VERSION)
    return lookup_by_keys(docs, wanted, "l_orderkey", LINE_VERSION, "o_orderkey")


SQL_ORDER_CUSTOMER = """
    SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_acctbal
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
"""


def _order_customer(spark, sf_dir, **limits):
    joined = lookup_join(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        "o_custkey",
        "c_custkey",
        "customer",
        **limits,
    )
    return joined.select("o_orderkey", "o_custkey", "o_totalprice", "customer.c_name", "customer.c_acctbal")


@query(SQL_ORDER_CUSTOMER, name="lookup_join")
def lookup_join_query(spark, sf_dir):
    return _order_customer(spark, sf_dir)


@query(SQL_ORDER_CUSTOMER)
def lookup_join_split(spark, sf_dir):
    """The way taken when the lookup is too large to broadcast and some of its keys are hot."""
    return _order_customer(spark, sf_dir, broadcast_rows=0, max_group_rows=12)


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def lookup_miss(spark, sf_dir):
    """A lookup that knows only some of the keys."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = lookup_join(docs, table(spark, sf_dir, "labels"), "doc_id", "doc_id", "label")
    return joined.select("doc_id", "lang", "label.quality", "label.toxic")
