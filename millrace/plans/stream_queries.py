"""The streaming operators, run over the test tables as streams until all input is processed.

Each must return what its batch twin returns.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.batching import tumbling_window
from millrace.operators.enrich import lookup_join
from millrace.operators.latest import latest_per_key
from millrace.plans.catalog import query, table
from millrace.plans.data import (
    EVENT_TYPES,
    FLAGS,
    LINE_FIELDS,
    LINE_VERSION,
    ORDER_FIELDS,
    ORDER_HEADER,
    SQL_KEY,
    SQL_VERSION,
    order_lines,
)
from millrace.plans.gate_queries import SQL_PROGRESS
from millrace.plans.ingest_queries import SQL_INGEST_COUNTS
from millrace.plans.join_queries import LINE_OUT, SQL_ENRICHED, SQL_ORDER_CUSTOMER
from millrace.plans.store_queries import SQL_LINES
from millrace.session import shared_dir, stream_session
from millrace.sinks.store import Store
from millrace.sources.streams import union_sources
from millrace.sources.delimited import split_delimited
from millrace.streaming.batching import chunk_stream, session_counts_stream
from millrace.streaming.enrich import expired_keys, start_enriching
from millrace.streaming.gate import count_gate_stream, expiring_gate_stream, gate_stream, running_count_stream
from millrace.streaming.ingest import ingest_totals, start_ingest
from millrace.streaming.jobs import commit_acks, run_available, start_index, write_batch


ROWS_PER_STATE_PARTITION = 1_000_000
# A micro-batch of a large table has several files, each read, sorted and written again by a task of its own.
ROWS_PER_FILE = 500_000


def streaming(spark, sf_dir, *names):
    """A session whose state partitions suit the size of the tables that will be streamed."""
    rows = sum(table(spark, sf_dir, n).count() for n in names)  # from the file footers
    cores = spark.sparkContext.defaultParallelism
    return stream_session(spark, max(cores, rows // ROWS_PER_STATE_PARTITION + 1))


def arriving_in_steps(df, label, steps=4):
    """A table as a stream of ``steps`` micro-batches, in no order."""
    path = shared_dir(df.sparkSession, label)
    files = files_per_step(df.count(), steps)
    df.repartition(steps * files).write.parquet(path)
    reader = df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", str(files))
    return reader.parquet(path)


def files_per_step(rows, steps):
    return max(1, -(-rows // (steps * ROWS_PER_FILE)))


def arriving_in_order(df, label, time, late_hours=0, end=False, steps=4):
    """A table as a stream of ``steps`` micro-batches by time; a row in twenty comes ``late_hours`` late.

    With ``end`` a last row follows that has nothing but a time far beyond all others: the end of the input.
    """
    late = F.when(F.col("seq") % 20 == 0, late_hours * 3_600_000_000).otherwise(0)
    placed = df.withColumn("_arrives", F.unix_micros(time) + late)
    borders = placed.approxQuantile("_arrives", [i / steps for i in range(1, steps)], 0.01)
    step = sum(((F.col("_arrives") > b).cast("int") for b in borders), F.lit(0))
    pieces = [placed.where(step == i).drop("_arrives") for i in range(steps)]
    if end:
        last = df.agg((F.max(time) + F.expr("INTERVAL 30 DAYS")).alias(time))
        nulls = {f.name: F.lit(None).cast(f.dataType) for f in df.schema if f.name != time}
        pieces.append(last.withColumns(nulls).select(df.columns))
    return arriving_one_by_one(pieces, label, df.count())


def arriving_one_by_one(pieces, label, rows):
    """Tables of one schema, ``rows`` in all, as a stream with one micro-batch for each."""
    spark, schema = pieces[0].sparkSession, pieces[0].schema
    path = shared_dir(spark, label)
    files = files_per_step(rows, len(pieces))
    for piece in pieces:
        piece.repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).parquet(path)


def _acks(events, *more):
    return events.select(
        F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("key"),
        F.col("event_type").alias("source"),
        _instant("ts").alias("commit_ts"),
        F.col("event_id").alias("seq"),
        *more,
    )


def _instant(column):
    """Table times carry no zone; as points in time they are UTC, whatever the session's zone."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column))
    return local.cast("timestamp").alias(column)


def _plain_time(df):
    """Back to times without a zone, as the tables have them."""

    def utc(name):
        local = F.col(name).cast("timestamp_ntz")
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local).alias(name)

    return df.select(*[utc(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes])


@query(
    f"""
    SELECT key, last_first_seen AS completed_ts, last_source AS completed_by
    FROM ({SQL_PROGRESS}) WHERE n_sources = 5
    """
)
def stream_gate_distinct(spark, sf_dir):
    """Acknowledgements arrive in four micro-batches by time; each complete key comes out once."""
    spark = streaming(spark, sf_dir, "events")
    events = arriving_in_order(_acks(table(spark, sf_dir, "events")), "events", "commit_ts")
    done = run_available(gate_stream(events, EVENT_TYPES), "gate", mode="update")
    return _plain_time(done.select("key", "completed_ts", "completed_by"))


@query(f"SELECT key FROM ({SQL_PROGRESS}) WHERE n_sources = 5")
def stream_gate_any_order(spark, sf_dir):
    """The same in no order: when and by what a key is completed depends on it, the set of keys does not."""
    spark = streaming(spark, sf_dir, "events")
    events = arriving_in_steps(_acks(table(spark, sf_dir, "events")), "events")
    return run_available(gate_stream(events, EVENT_TYPES), "gate", mode="update").select("key")


@query(f"SELECT {SQL_KEY} AS key, COUNT(*) AS running FROM events GROUP BY 1")
def stream_running_count(spark, sf_dir):
    spark = streaming(spark, sf_dir, "events")
    events = arriving_in_steps(table(spark, sf_dir, "events"), "events")
    counts = run_available(running_count_stream(_acks(events)), "counts", mode="update")
    return latest_per_key(counts, ["key"], ["batch_id"], ["running"])


@query(
    f"""
    SELECT {SQL_KEY} AS key, event_type AS source, ts AS commit_ts, event_id AS seq FROM events
    QUALIFY row_number() OVER (PARTITION BY {SQL_KEY} ORDER BY ts, event_id) = 4
    """
)
def stream_gate_count(spark, sf_dir):
    spark = streaming(spark, sf_dir, "events")
    events = arriving_in_order(_acks(table(spark, sf_dir, "events")), "events", "commit_ts")
    done = run_available(count_gate_stream(events, 4), "count-gate")
    return _plain_time(done.drop("batch_id"))


@query(
    f"""
    SELECT p.key, CASE WHEN n_sources = 5 THEN 'complete' ELSE 'expired' END AS status,
           5 - n_sources AS n_missing
    FROM ({SQL_PROGRESS}) p
    """
)
def stream_gate_expired(spark, sf_dir):
    """Rows up to six hours late; the end of the input lets all open keys expire."""
    spark = streaming(spark, sf_dir, "events")
    events = arriving_in_order(_acks(table(spark, sf_dir, "events")), "events", "commit_ts", late_hours=6, end=True)
    gated = expiring_gate_stream(events, EVENT_TYPES, "2 days", delay="6 hours")
    done = run_available(gated, "expiring-gate")
    n = F.when(F.col("missing") == "", 0).otherwise(F.size(F.split("missing", ",")))
    return done.select("key", "status", n.cast("bigint").alias("n_missing"))


def _enriched(spark, store, label, sources, fields, key_type, **options):
    """Everything that is committed goes through the gate; returns what was joined and where expired keys are."""
    out = shared_dir(spark, label)

    def use(parts, batch_id):
        write_batch(parts, f"{out}/joined", batch_id)

    start_enriching(
        spark, store, sources, fields, out, f"{out}-checkpoint", use, key_type=key_type, once=True, **options
    ).awaitTermination()
    return spark.read.option("mergeSchema", "true").parquet(f"{out}/joined").drop("batch_id"), out


@query(SQL_ENRICHED)
def stream_enrich_nway(spark, sf_dir):
    """Lines arrive in three micro-batches, older versions after newer ones; orders complete the keys in two more."""
    spark = streaming(spark, sf_dir, "orders", "lineitem")
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    nothing = F.lit(None)
    items = lines.select(
        F.col("l_orderkey").alias("key"),
        F.concat(F.lit("flag_"), F.lower("l_returnflag")).alias("source"),
        F.struct(*LINE_VERSION).alias("version"),
        F.struct(*LINE_FIELDS).alias("line"),
        nothing.cast(T.StructType([orders.schema[f] for f in ORDER_FIELDS])).alias("bill"),
    )
    bills = orders.select(
        F.col("o_orderkey").alias("key"),
        F.lit("billing").alias("source"),
        F.struct(F.col("o_orderdate").alias(LINE_VERSION[0]), *[nothing.cast(lines.schema[c].dataType).alias(c) for c in LINE_VERSION[1:]]).alias("version"),
        nothing.cast(T.StructType([lines.schema[f] for f in LINE_FIELDS])).alias("line"),
        F.struct(*ORDER_FIELDS).alias("bill"),
    )
    pieces = [items.where(F.pmod(F.xxhash64("version"), F.lit(3)) == i) for i in range(3)]
    pieces += [bills.where(F.pmod(F.xxhash64("key"), F.lit(2)) == i) for i in range(2)]
    messages = arriving_one_by_one(pieces, "messages", orders.count() + lines.count())
    store = Store(shared_dir(spark, "parts"), "key", ["version"])
    start_index(messages, store, f"{store.root}/checkpoint", once=True).awaitTermination()
    parts, _ = _enriched(spark, store, "enriched", ["billing", *FLAGS], ["line", "bill"], "bigint")
    parts = parts.select("key", F.col("billing.bill").alias("billing"), *[F.col(n)["line"].alias(n) for n in FLAGS])
    records = lookup_join(parts, table(spark, sf_dir, "customer"), "billing.o_custkey", "c_custkey", "customer")
    return records.select(
        "key",
        "billing.o_custkey",
        "billing.o_totalprice",
        *[F.col(f"{n}.{c}").alias(f"{n}_{a}") for n in FLAGS for c, a in LINE_OUT.items()],
        "customer.c_name",
        "customer.c_mktsegment",
    )


@query(
    f"""
    SELECT p.key, CASE WHEN n_sources = 5 THEN 'complete' ELSE 'expired' END AS status, 5 - n_sources AS n_missing,
           CASE WHEN n_sources = 5 THEN newest.click END AS click, CASE WHEN n_sources = 5 THEN newest.error END AS error,
           CASE WHEN n_sources = 5 THEN newest.purchase END AS purchase
    FROM ({SQL_PROGRESS}) p JOIN (
        SELECT {SQL_KEY} AS key,
               max_by(props, {{'a': ts, 'b': event_id}}) FILTER (WHERE event_type = 'click') AS click,
               max_by(props, {{'a': ts, 'b': event_id}}) FILTER (WHERE event_type = 'error') AS error,
               max_by(props, {{'a': ts, 'b': event_id}}) FILTER (WHERE event_type = 'purchase') AS purchase
        FROM events GROUP BY 1) newest USING (key)
    """
)
def stream_enrich_expired(spark, sf_dir):
    """Events of a user and day as parts, up to six hours late, committed at their own time. Complete days are joined with their
    stored parts; the end of the input lets the others expire, with what they miss."""
    spark = streaming(spark, sf_dir, "events")
    events = table(spark, sf_dir, "events")
    rows = _acks(events, F.col("props").alias("value"))
    arriving = arriving_in_order(rows, "events", "commit_ts", late_hours=6, end=True)
    store = Store(shared_dir(spark, "parts"), "key", ["commit_ts", "seq"])
    start_index(
        arriving, store, f"{store.root}/checkpoint", once=True, committed=F.col("commit_ts"), refresh_every=2
    ).awaitTermination()
    parts, out = _enriched(spark, store, "enriched", EVENT_TYPES, ["value"], "string", wait="2 days", delay="6 hours")
    done = parts.select(
        "key", F.lit("complete").alias("status"), F.lit(0).cast("bigint").alias("n_missing"),
        *[F.col(n)["value"].alias(n) for n in ("click", "error", "purchase")],
    )
    n = F.size(F.split("missing", ",")).cast("bigint").alias("n_missing")
    lost = expired_keys(spark, out).select("key", F.lit("expired").alias("status"), n)
    return done.unionByName(lost, allowMissingColumns=True)


@query(
    """
    SELECT source, shard, window_start, window_start + INTERVAL '1 day' AS window_end, chunk, COUNT(*) AS n,
           CASE WHEN COUNT(*) = 50 THEN 'count' ELSE 'timeout' END AS reason
    FROM (SELECT event_type AS source, event_id % 2 AS shard, time_bucket(INTERVAL '1 day', ts) AS window_start,
                 CAST(floor((row_number() OVER (PARTITION BY event_type, event_id % 2,
                                                             time_bucket(INTERVAL '1 day', ts)
                                                ORDER BY ts, event_id) - 1) / 50) AS BIGINT) AS chunk
          FROM events)
    GROUP BY source, shard, window_start, chunk
    """
)
def stream_count_or_timeout(spark, sf_dir):
    """Chunks per source and shard, of rows up to six hours late; the end of the input closes the last window."""
    spark = streaming(spark, sf_dir, "events")
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        _instant("ts"),
        F.col("event_id").alias("seq"),
        F.col("props").alias("value"),
    )
    events = arriving_in_order(rows, "events", "ts", late_hours=6, end=True)
    chunks = chunk_stream(events, shard=F.col("seq") % 2, rows=50, timeout="1 day", delay="6 hours")
    done = _plain_time(run_available(chunks, "chunks"))
    return done.select(
        "source",
        F.col("shard").cast("bigint").alias("shard"),
        "window_start",
        "window_end",
        "chunk",
        F.size("documents").cast("bigint").alias("n"),
        "reason",
    )


@query(
    """
    SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS last_ts, COUNT(*) AS n
    FROM (SELECT user_id, ts, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session
          FROM (SELECT user_id, ts, event_id,
                       CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL '6 hours'
                            THEN 0 ELSE 1 END AS fresh
                FROM events))
    GROUP BY user_id, session
    """
)
def stream_session_counts(spark, sf_dir):
    """Sessions of users over four micro-batches, with rows up to six hours late that join sessions; the end of the input closes the last."""
    spark = streaming(spark, sf_dir, "events")
    rows = table(spark, sf_dir, "events").select("user_id", _instant("ts"), F.col("event_id").alias("seq"))
    events = arriving_in_order(rows, "events", "ts", late_hours=6, end=True)
    sessions = session_counts_stream(events, "ts", 6 * 3600, ["user_id"], delay="6 hours")
    return _plain_time(run_available(sessions, "sessions").drop("batch_id").where("user_id IS NOT NULL"))


@query(SQL_INGEST_COUNTS)
def stream_ingest_counts(spark, sf_dir):
    """Delimited lines in four micro-batches, counted while they are written."""
    spark = streaming(spark, sf_dir, "orders")
    lines = order_lines(spark, sf_dir)
    split = split_delimited(arriving_in_steps(lines, "lines"), ORDER_HEADER)
    out = shared_dir(spark, "ingest")
    # One source is not declared; its rows are kept and counted all the same.
    start_ingest(split, ["F", "O"], out, f"{out}-checkpoint", once=True).awaitTermination()
    totals = ingest_totals(spark, out)
    return totals.withColumn("source", F.coalesce("source", F.lit("P")))


def _indexed_lines(spark, sf_dir):
    """Lines that arrive in four micro-batches, put into a store."""
    lines = arriving_in_steps(
        table(spark, sf_dir, "lineitem").select(
            F.when(F.col("l_quantity") != 50, F.col("l_orderkey")).alias("l_orderkey"),
            *LINE_VERSION,
            F.col("l_linestatus").alias("source"),
        ),
        "lines",
    )
    store = Store(shared_dir(spark, "stream-store"), "l_orderkey", LINE_VERSION)
    start_index(lines, store, f"{store.root}/checkpoint", once=True).awaitTermination()
    return store


@query(
    f"""
    SELECT source, l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity
    FROM ({SQL_LINES}) WHERE l_orderkey IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY source, l_orderkey ORDER BY {SQL_VERSION} DESC) = 1
    """
)
def stream_upsert_current(spark, sf_dir):
    """Lines arrive in four micro-batches; the store keeps the newest of each key."""
    store = _indexed_lines(streaming(spark, sf_dir, "lineitem"), sf_dir)
    return store.current(spark).drop("batch_id")


@query(
    f"""
    SELECT source, l_orderkey AS key, CASE WHEN l_orderkey IS NULL THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN l_orderkey IS NULL THEN 'missing key' END AS error
    FROM ({SQL_LINES})
    """
)
def stream_commit_log(spark, sf_dir):
    """One row per document, written by a stream."""
    store = _indexed_lines(streaming(spark, sf_dir, "lineitem"), sf_dir)
    return store.log(spark).select("source", "key", "status", "error")


@query(
    f"""
    SELECT l_orderkey AS key FROM ({SQL_LINES}) WHERE l_orderkey IS NOT NULL
    GROUP BY l_orderkey HAVING COUNT(DISTINCT source) = 2
    """
)
def stream_commit_gate(spark, sf_dir):
    """The gate fed by the commit log: orders of which lines of both states have been committed."""
    spark = streaming(spark, sf_dir, "lineitem")
    store = _indexed_lines(spark, sf_dir)
    done = run_available(gate_stream(commit_acks(spark, store, "bigint"), ["O", "F"]), "commit-gate", mode="update")
    return done.select("key")


@query(
    """
    SELECT 'billing' AS source, o_orderkey AS key, o_orderdate AS version FROM orders
    UNION ALL
    SELECT 'line' AS source, l_orderkey AS key, l_shipdate AS version FROM lineitem
    """
)
def stream_union_sources(spark, sf_dir):
    spark = streaming(spark, sf_dir, "orders", "lineitem")
    orders = arriving_in_steps(table(spark, sf_dir, "orders"), "orders")
    lines = arriving_in_steps(table(spark, sf_dir, "lineitem"), "lines")
    merged = union_sources(
        {
            "billing": orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("version")),
            "line": lines.select(F.col("l_orderkey").alias("key"), F.col("l_shipdate").alias("version")),
        }
    )
    return run_available(merged, "union").drop("batch_id")


@query(SQL_ORDER_CUSTOMER)
def stream_lookup_join(spark, sf_dir):
    """Orders as a stream, customers as a static lookup."""
    spark = streaming(spark, sf_dir, "orders")
    found = lookup_join(
        arriving_in_steps(table(spark, sf_dir, "orders"), "orders"),
        table(spark, sf_dir, "customer"),
        "o_custkey",
        "c_custkey",
        "customer",
    )
    joined = found.select("o_orderkey", "o_custkey", "o_totalprice", "customer.c_name", "customer.c_acctbal")
    return run_available(joined, "lookup").drop("batch_id")


@query(
    """
    SELECT time_bucket(INTERVAL '20 seconds', ts) AS window_start,
           time_bucket(INTERVAL '20 seconds', ts) + INTERVAL '20 seconds' AS window_end,
           event_type, COUNT(*) AS n, MIN(ts) AS first_ts, MAX(ts) AS last_ts
    FROM events GROUP BY ALL
    """
)
def stream_tumbling_window(spark, sf_dir):
    """Windows counted over four micro-batches; the last update of each window stands."""
    spark = streaming(spark, sf_dir, "events")
    events = arriving_in_steps(table(spark, sf_dir, "events"), "events")
    windows = tumbling_window(events.withColumn("ts", _instant("ts")), "ts", "20 seconds", ["event_type"])
    updates = run_available(windows, "windows", mode="update")
    keys = ["window_start", "window_end", "event_type"]
    return _plain_time(latest_per_key(updates, keys, ["batch_id"], ["n", "first_ts", "last_ts"]))
