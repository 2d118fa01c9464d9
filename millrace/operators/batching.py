"""Windows and count-or-timeout chunks over stored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.operators.skew import MAX_GROUP_ROWS, fits_broadcast, hot_groups, ordered_position, same_values, slices_of
from millrace.session import materialize


def tumbling_window(
    df: DataFrame, ts: str, width: str = "20 seconds", groups: Sequence[str] = ()
) -> DataFrame:
    """Rows per fixed window (and group)."""
    return (
        df.groupBy(F.window(ts, width).alias("_w"), *groups)
        .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *groups,
            "n",
            "first_ts",
            "last_ts",
        )
    )


def assign_chunks(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    groups: Sequence[str] = ("source",),
    rows: int = 50,
    timeout: str = "20 seconds",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Number the chunks each source's rows fall into: a chunk closes with its last row or with
    its window, whichever is first, and never crosses a window border."""
    windowed = df.withColumn("_w", F.window(ts, timeout))
    windowed = windowed.select(
        *df.columns, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")
    )
    numbered = ordered_position(
        windowed, [*groups, "window_start", "window_end"], order, "_n", max_group_rows
    )
    return numbered.withColumn("chunk", F.floor((F.col("_n") - 1) / rows).cast("bigint")).drop("_n")


def chunk_summary(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    groups: Sequence[str] = ("source",),
    rows: int = 50,
    timeout: str = "20 seconds",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per chunk: its size, why it closed and when."""
    chunks = assign_chunks(df, ts, order, groups, rows, timeout, max_group_rows)
    full = F.col("n") == rows
    return (
        chunks.groupBy(*groups, "window_start", "window_end", "chunk")
        .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
        .withColumn("reason", F.when(full, "count").otherwise("timeout"))
        .withColumn("fire_ts", F.when(full, F.col("last_ts")).otherwise(F.col("window_end")))
    )


def session_counts(
    df: DataFrame, ts: str, gap_seconds: int, groups: Sequence[str], max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Rows per session, a session ending when nothing comes for ``gap_seconds``.

    Rows closer than the gap always share a session, so they are first counted per gap-wide bucket
    (combined before the shuffle). Only buckets are sorted: a hot group costs its time span, not
    its rows. Groups above ``max_group_rows`` are sorted in ranges. ``df`` is read more than once.
    """
    if not groups:
        whole = df.withColumn("_all", F.lit(0))
        return session_counts(whole, ts, gap_seconds, ["_all"], max_group_rows).drop("_all")
    gap = gap_seconds * 1_000_000
    hot = hot_groups(df, groups, max_group_rows)
    if hot is None:
        sessions = _numbered_sessions(_buckets(df, ts, gap, groups), gap, groups)
    else:
        same = hot.condition(df)
        few = _buckets(df.join(hot.keys, same, "left_anti"), ts, gap, groups)
        many = _buckets(df.join(hot.keys, same, "left_semi"), ts, gap, groups)
        slices = slices_of(hot.rows, max_group_rows)
        sessions = _numbered_sessions(few, gap, groups).unionByName(_sessions_by_ranges(many, gap, groups, slices))
    return sessions.groupBy(*groups, "session").agg(
        F.min("_first").alias("session_start"),
        F.max("_last").alias("last_ts"),
        F.sum("_n").alias("n"),
    )


def _buckets(df: DataFrame, ts: str, gap: int, groups: Sequence[str]) -> DataFrame:
    # Times without a zone are counted as they stand, so no clock change of the session's zone moves them.
    zoneless = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    epoch = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{}`)"
    micros = F.expr(epoch.format(ts)) if zoneless else F.unix_micros(F.col(ts).cast("timestamp"))
    return df.groupBy(*groups, (micros - F.pmod(micros, F.lit(gap))).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.min(micros).alias("_first_us"),
        F.max(micros).alias("_last_us"),
    )


def _is_new(previous: Column, gap: int) -> Column:
    """Whether a bucket begins a session, by the end of the bucket before it."""
    return F.coalesce(F.col("_first_us") - previous > gap, F.lit(True)).cast("int")


def _numbered_sessions(buckets: DataFrame, gap: int, groups: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*groups).orderBy("_bucket")
    marked = buckets.withColumn("_new", _is_new(F.lag("_last_us").over(window), gap))
    return marked.select(*groups, "_n", "_first", "_last", F.sum("_new").over(window).alias("session"))


def _sessions_by_ranges(buckets: DataFrame, gap: int, groups: Sequence[str], slices: int) -> DataFrame:
    """The same for long groups: number within ranges of buckets, then add what earlier ranges hold.

    The ranged buckets are written first, so that slice numbers cannot change between their uses.
    """
    ranged = buckets.repartitionByRange(slices, *groups, "_bucket").withColumn("_slice", F.spark_partition_id())
    stored = materialize(ranged, "buckets")
    names = {"_slice": "_of_slice"} | {g: f"_of_{g}" for g in groups}
    slice_order = Window.partitionBy(*[names[g] for g in groups]).orderBy("_of_slice")

    def per_slice(rows: DataFrame, value: Column, carried: Column, out: str) -> DataFrame:
        """Rows with what earlier slices of their group hand on; one row per slice and group is joined."""
        ends = rows.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(value.alias("_value"))
        ends = materialize(ends.withColumn(out, carried).drop("_value"), "ends")
        small = F.broadcast(ends) if fits_broadcast(ends) else ends
        return rows.join(small, same_values(rows, small, names), "left").drop(*names.values())

    window = Window.partitionBy("_slice", *groups).orderBy("_bucket")
    linked = per_slice(stored, F.max("_last_us"), F.lag("_value").over(slice_order), "_before")
    previous = F.coalesce(F.lag("_last_us").over(window), F.col("_before"))
    marked = linked.withColumn("_new", _is_new(previous, gap))
    earlier = F.sum("_value").over(slice_order.rowsBetween(Window.unboundedPreceding, -1))
    shifted = per_slice(marked, F.sum("_new"), F.coalesce(earlier, F.lit(0)), "_shift")
    number = F.sum("_new").over(window) + F.col("_shift")
    return shifted.select(*groups, "_n", "_first", "_last", number.alias("session"))
