"""Ingest helpers: row budgets, surrogate keys, counts of good and malformed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import MAX_GROUP_ROWS, first_rows, ordered_position


def take_rows(
    df: DataFrame,
    n: int,
    order: Sequence[str],
    source: str | None = "source",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The first ``n`` rows of each source in file order. Malformed rows use up the budget too,
    so take rows before dropping those."""
    if source is None:
        whole = df.withColumn("_all", F.lit(0))
        return take_rows(whole, n, order, "_all", max_group_rows).drop("_all")
    return first_rows(df, [source], order, n, "_rank", max_group_rows).drop("_rank")


def surrogate_keys(
    df: DataFrame,
    natural: Sequence[str],
    source: str = "source",
    name: str = "pcn",
    seed: str = "42",
    max_group_rows: int = MAX_GROUP_ROWS,
    mix: int | None = None,
) -> DataFrame:
    """Dense keys 0..n-1 per source, given in a random but repeatable order.

    The order is that of a seeded hash of the natural key, so sources come out mutually shuffled
    and a rerun gives the same keys. With ``mix`` only the first so many columns of the natural key are hashed,
    the others settle ties.
    """
    mixed = F.md5(F.concat_ws("|", F.lit(seed), F.col(source), *[F.col(c).cast("string") for c in natural[:mix]]))
    numbered = ordered_position(
        df.withColumn("_mix", mixed), [source], ["_mix", *natural], name, max_group_rows
    )
    return numbered.withColumn(name, F.col(name) - 1).drop("_mix")


def ingest_counts(split: DataFrame, source: str = "source", bad: str = "_bad") -> DataFrame:
    """Good and malformed rows per source."""
    return split.groupBy(source).agg(
        F.count_if(~F.col(bad)).alias("good"), F.count_if(F.col(bad)).alias("malformed")
    )
