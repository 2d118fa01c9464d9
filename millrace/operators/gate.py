"""The completeness gate: which keys have been committed by every expected source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import MAX_GROUP_ROWS, first_rows, ordered_position


def usable(acks: DataFrame, sources: Sequence[str], key: str = "key", ts: str = "commit_ts") -> Column:
    """Whether an acknowledgement counts: known source, key and time present, write not failed."""
    ok = F.col("source").isin(*sources) & F.col(key).isNotNull() & F.col(ts).isNotNull()
    if "status" in acks.columns:
        ok = ok & (F.col("status") == "ok")
    return ok


def usable_acks(acks: DataFrame, sources: Sequence[str], key: str = "key", ts: str = "commit_ts") -> DataFrame:
    return acks.where(usable(acks, sources, key, ts))


def rejection(acks: DataFrame, sources: Sequence[str], key: str = "key", ts: str = "commit_ts") -> Column:
    """Why an acknowledgement does not count; null if it does."""
    reason = (
        F.when(F.col(key).isNull(), "missing key")
        .when(F.col(ts).isNull(), "missing time")
        .when(F.col("source").isNull() | ~F.col("source").isin(*sources), "unknown source")
    )
    if "status" in acks.columns:
        reason = reason.when(F.coalesce(F.col("status"), F.lit("")) != "ok", "write failed")
    return reason


def rejected_acks(acks: DataFrame, sources: Sequence[str], key: str = "key", ts: str = "commit_ts") -> DataFrame:
    """Those that do not count, with the reason."""
    return acks.withColumn("reason", rejection(acks, sources, key, ts)).where(F.col("reason").isNotNull())


def progress_columns(sources: Sequence[str], firsts: Sequence[str]) -> dict[str, Column]:
    """What the first times of all sources say of a key, for any number of sources: ``seen`` (names), ``first`` (the earliest
    time), ``complete``, ``last`` and ``by`` (the time and the source that completed it; of several at that time the one declared first)."""
    times = F.array(*firsts)
    names = F.array(*[F.lit(n) for n in sources])
    last = F.array_max(times)
    return {
        "seen": F.array_compact(F.array(*[F.when(F.col(t).isNotNull(), F.lit(n)) for t, n in zip(firsts, sources)])),
        "first": F.array_min(times),
        "complete": ~F.exists(times, lambda t: t.isNull()),
        "last": last,
        "by": F.element_at(names, F.array_position(times, last).cast("int")),
    }


def source_progress(
    acks: DataFrame, sources: Sequence[str], key: str = "key", ts: str = "commit_ts"
) -> DataFrame:
    """Per key: number of arrivals, sources seen and the first time of each.

    Result columns: key, arrivals, seen (array of names), first_ts, completed_ts, completed_by;
    the last two are null while a source is missing. Counts and minima are all combined
    before the one shuffle, so a hot key costs a few rows per input task.
    """
    acks = usable_acks(acks, sources, key, ts)
    firsts = [f"_t{i}" for i in range(len(sources))]
    progress = acks.groupBy(key).agg(
        F.count(F.lit(1)).alias("arrivals"),
        *[F.min(F.when(F.col("source") == name, F.col(ts))).alias(t) for t, name in zip(firsts, sources)],
    )
    found = progress_columns(sources, firsts)
    return progress.select(
        key,
        "arrivals",
        found["seen"].alias("seen"),
        found["first"].alias("first_ts"),
        F.when(found["complete"], found["last"]).alias("completed_ts"),
        F.when(found["complete"], found["by"]).alias("completed_by"),
    )


def gate_distinct(
    acks: DataFrame, sources: Sequence[str], key: str = "key", ts: str = "commit_ts"
) -> DataFrame:
    """Keys committed by every expected source, each exactly once, with the time and the source
    that completed them. Redelivered acknowledgements change nothing."""
    return (
        source_progress(acks, sources, key, ts)
        .where(F.col("completed_ts").isNotNull())
        .select(key, "arrivals", "completed_ts", "completed_by")
    )


def incomplete_keys(
    acks: DataFrame, sources: Sequence[str], key: str = "key", ts: str = "commit_ts"
) -> DataFrame:
    """Keys still waiting, and for what."""
    expected = F.array(*[F.lit(s) for s in sources])
    return (
        source_progress(acks, sources, key, ts)
        .where(F.col("completed_ts").isNull())
        .select(key, "arrivals", "first_ts", "seen", F.array_except(expected, "seen").alias("missing"))
    )


def running_count(
    acks: DataFrame,
    key: str = "key",
    order: Sequence[str] = ("commit_ts", "seq"),
    name: str = "running",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Number of acknowledgements of a key up to and including each arrival."""
    return ordered_position(acks, [key], list(order), name, max_group_rows)


def gate_count(
    acks: DataFrame,
    n: int,
    key: str = "key",
    order: Sequence[str] = ("commit_ts", "seq"),
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The arrival that brings a key's count to ``n``; sources are not told apart."""
    return first_rows(acks, [key], order, n, "_n", max_group_rows).where(F.col("_n") == n).drop("_n")


def probe_cost(
    acks: DataFrame, sources: Sequence[str], key: str = "key", ts: str = "commit_ts"
) -> DataFrame:
    """Store look-ups needed with and without the gate: every arrival probing the other sources,
    against one look-up per part plus one for the lookup table for each complete key."""
    n = len(sources)
    return source_progress(acks, sources, key, ts).agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("completed_ts").isNotNull()).alias("complete_keys"),
        F.sum("arrivals").alias("arrivals"),
        (F.sum("arrivals") * (n - 1)).alias("naive_probes"),
        (F.count_if(F.col("completed_ts").isNotNull()) * (n + 1)).alias("gated_probes"),
    )
