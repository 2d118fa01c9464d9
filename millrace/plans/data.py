"""How the test tables stand in for the engine's inputs.

Parts of one record: an order and its lines by return flag, keyed by the order key. Line versions
are ordered by LINE_VERSION, which identifies a line. Acknowledgements: events, keyed by user and
day, the event type being the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.enrich import Part
from millrace.plans.catalog import table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
FLAGS = {"flag_a": "A", "flag_n": "N", "flag_r": "R"}
LINE_VERSION = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
ORDER_FIELDS = ["o_custkey", "o_totalprice", "o_orderpriority"]
LINE_FIELDS = ["l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_linestatus"]

# The same in SQL.
SQL_VERSION = (
    "struct_pack(a := l_shipdate, b := l_linenumber, c := l_partkey, d := l_suppkey, e := l_quantity)"
)
SQL_KEY = "CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d')"


def parts(spark: SparkSession, sf_dir: str) -> list[Part]:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return [
        Part("billing", orders, "o_orderkey", ["o_orderdate"], ORDER_FIELDS),
        *[
            Part(name, lines, "l_orderkey", LINE_VERSION, LINE_FIELDS, F.col("l_returnflag") == flag)
            for name, flag in FLAGS.items()
        ],
    ]


def acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acknowledgements: key, source, commit_ts, seq."""
    return table(spark, sf_dir, "events").select(
        F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("key"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("commit_ts"),
        F.col("event_id").alias("seq"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as delimited text with the usual damage: an order of the lowest priority lost the
    text of its last column, a pending one the whole column, an urgent final one has a column more."""
    o = table(spark, sf_dir, "orders")
    cells = [
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        F.col("o_orderstatus"),
        F.date_format("o_orderdate", "MM-dd-yyyy"),
    ]
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    line = (
        F.when(status == "P", F.concat_ws("\t", *cells))
        .when(priority == "5-LOW", F.concat_ws("\t", *cells, F.lit("")))
        .when((status == "F") & (priority == "1-URGENT"), F.concat_ws("\t", *cells, priority, F.lit("extra")))
        .otherwise(F.concat_ws("\t", *cells, priority))
    )
    return o.select(status.alias("source"), line.alias("value"))


ORDER_HEADER = ["orderkey", "custkey", "status", "orderdate", "priority"]
SQL_ORDER_CELLS = (
    "CAST(o_orderkey AS VARCHAR) || chr(9) || CAST(o_custkey AS VARCHAR) || chr(9) || o_orderstatus "
    "|| chr(9) || strftime(o_orderdate, '%m-%d-%Y')"
)
