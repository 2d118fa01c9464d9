"""Completeness gates, counts and chunks over acknowledgements."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.batching import chunk_summary, session_counts, tumbling_window
from millrace.operators.gate import (
    gate_count,
    gate_distinct,
    incomplete_keys,
    probe_cost,
    rejected_acks,
    running_count,
)
from millrace.plans.catalog import query, table
from millrace.plans.data import EVENT_TYPES, SQL_KEY, acks

SQL_PROGRESS = f"""
    SELECT key, COUNT(*) AS arrivals, COUNT(DISTINCT source) AS n_sources, MIN(ts) AS first_ts,
           MAX(first_seen) AS last_first_seen, arg_max(source, first_seen) AS last_source
    FROM (SELECT {SQL_KEY} AS key, event_type AS source, ts,
                 MIN(ts) OVER (PARTITION BY {SQL_KEY}, event_type) AS first_seen FROM events)
    GROUP BY key
"""


@query(
    f"""
    SELECT key, arrivals, last_first_seen AS completed_ts, last_source AS completed_by
    FROM ({SQL_PROGRESS}) WHERE n_sources = 5
    """,
    name="gate_distinct",
)
def gate_distinct_query(spark, sf_dir):
    return gate_distinct(acks(spark, sf_dir), EVENT_TYPES)


@query(
    """
    SELECT seq, reason
    FROM (SELECT event_id AS seq, CASE WHEN user_id % 10 = 0 THEN 'missing key'
                                       WHEN event_type = 'view' THEN 'unknown source' END AS reason FROM events)
    WHERE reason IS NOT NULL
    """,
    name="rejected_acks",
)
def rejected_acks_query(spark, sf_dir):
    """Every tenth user has lost the key, and views are not expected."""
    damaged = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("key"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("commit_ts"),
        F.col("event_id").alias("seq"),
    )
    return rejected_acks(damaged, [t for t in EVENT_TYPES if t != "view"]).select("seq", "reason")


@query(
    f"""
    SELECT p.key, arrivals, first_ts, missing, 5 - n_sources AS n_missing
    FROM ({SQL_PROGRESS}) p
    JOIN (SELECT k.key, string_agg(t.event_type, ',' ORDER BY t.event_type) AS missing
          FROM (SELECT DISTINCT {SQL_KEY} AS key FROM events) k
          CROSS JOIN (SELECT DISTINCT event_type FROM events) t
          WHERE NOT EXISTS (SELECT 1 FROM (SELECT {SQL_KEY} AS key, event_type FROM events) e
                            WHERE e.key = k.key AND e.event_type = t.event_type)
          GROUP BY k.key) m ON m.key = p.key
    WHERE n_sources < 5
    """,
    name="incomplete_keys",
)
def incomplete_keys_query(spark, sf_dir):
    waiting = incomplete_keys(acks(spark, sf_dir), EVENT_TYPES)
    return waiting.select(
        "key",
        "arrivals",
        "first_ts",
        F.array_join(F.array_sort("missing"), ",").alias("missing"),
        F.size("missing").cast("bigint").alias("n_missing"),
    )


@query(
    f"""
    SELECT {SQL_KEY} AS key, event_type AS source, ts AS commit_ts, event_id AS seq FROM events
    QUALIFY row_number() OVER (PARTITION BY {SQL_KEY} ORDER BY ts, event_id) = 4
    """,
    name="gate_count",
)
def gate_count_query(spark, sf_dir):
    return gate_count(acks(spark, sf_dir), 4)


@query(
    f"""
    SELECT {SQL_KEY} AS key, event_type AS source, ts AS commit_ts, event_id AS seq,
           row_number() OVER (PARTITION BY {SQL_KEY} ORDER BY ts, event_id) AS running
    FROM events
    """,
    name="running_count",
)
def running_count_query(spark, sf_dir):
    return running_count(acks(spark, sf_dir))


@query(
    """
    SELECT event_type AS source, ts AS commit_ts, event_id AS seq,
           row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS running
    FROM events
    """
)
def running_count_split(spark, sf_dir):
    """Running count over few, very large groups; each is split over several tasks."""
    rows = acks(spark, sf_dir).select("source", "commit_ts", "seq")
    return running_count(rows, key="source", max_group_rows=1500)


@query(
    f"""
    SELECT COUNT(*) AS keys, COUNT(*) FILTER (WHERE n_sources = 5) AS complete_keys,
           CAST(SUM(arrivals) AS BIGINT) AS arrivals, CAST(SUM(arrivals) * 4 AS BIGINT) AS naive_probes,
           CAST(COUNT(*) FILTER (WHERE n_sources = 5) * 6 AS BIGINT) AS gated_probes
    FROM ({SQL_PROGRESS})
    """,
    name="probe_cost",
)
def probe_cost_query(spark, sf_dir):
    return probe_cost(acks(spark, sf_dir), EVENT_TYPES)


@query(
    """
    SELECT time_bucket(INTERVAL '20 seconds', ts) AS window_start,
           time_bucket(INTERVAL '20 seconds', ts) + INTERVAL '20 seconds' AS window_end,
           event_type, COUNT(*) AS n, MIN(ts) AS first_ts, MAX(ts) AS last_ts
    FROM events GROUP BY ALL
    """,
    name="tumbling_window",
)
def tumbling_window_query(spark, sf_dir):
    return tumbling_window(table(spark, sf_dir, "events"), "ts", "20 seconds", ["event_type"])


SQL_CHUNKS = """
    SELECT source, window_start, window_start + INTERVAL '1 day' AS window_end, chunk, COUNT(*) AS n,
           MIN(ts) AS first_ts, MAX(ts) AS last_ts,
           CASE WHEN COUNT(*) = 50 THEN 'count' ELSE 'timeout' END AS reason,
           CASE WHEN COUNT(*) = 50 THEN MAX(ts) ELSE window_start + INTERVAL '1 day' END AS fire_ts
    FROM (SELECT event_type AS source, ts, time_bucket(INTERVAL '1 day', ts) AS window_start,
                 CAST(floor((row_number() OVER (PARTITION BY event_type, time_bucket(INTERVAL '1 day', ts)
                                                ORDER BY ts, event_id) - 1) / 50) AS BIGINT) AS chunk
          FROM events)
    GROUP BY source, window_start, chunk
"""


def _chunks(spark, sf_dir, **limits):
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), "ts", "event_id")
    return chunk_summary(events, "ts", ["ts", "event_id"], rows=50, timeout="1 day", **limits)


@query(SQL_CHUNKS)
def count_or_timeout(spark, sf_dir):
    return _chunks(spark, sf_dir)


@query(SQL_CHUNKS)
def count_or_timeout_split(spark, sf_dir):
    """The same with windows that are too large for one task."""
    return _chunks(spark, sf_dir, max_group_rows=60)


@query(
    """
    SELECT user_id, session, MIN(ts) AS session_start, MAX(ts) AS last_ts, COUNT(*) AS n
    FROM (SELECT user_id, ts, CAST(SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                   ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session
          FROM (SELECT user_id, ts, event_id,
                       CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                                 <= INTERVAL '6 hours' THEN 0 ELSE 1 END AS fresh
                FROM events))
    GROUP BY user_id, session
    """,
    name="session_counts",
)
def session_counts_query(spark, sf_dir):
    return session_counts(table(spark, sf_dir, "events"), "ts", 6 * 3600, ["user_id"])
