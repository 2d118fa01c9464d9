"""Numbering and joining rows when one group may hold a large share of all rows.

Ordinary groups take the plain Spark plan (one hash shuffle). Only groups above ``max_group_rows``
are treated apart: numbering splits them over range partitions, joining broadcasts their few
right-hand rows. Results are exact either way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.session import materialize

# A group of this many rows is still a comfortable sort for one task.
MAX_GROUP_ROWS = 4_000_000
# Large groups are cut in so many slices however low the limit, beyond that only where each has so many rows: a task for
# a few rows costs more than sorting them, and the sample that finds the borders grows with the number of slices.
MIN_SLICES = 64
MIN_SLICE_ROWS = 250_000
# Input tasks that a very large table is read by, and pieces a group is cut in.
MAX_TASKS = 100_000
MAX_SALTS = 1_000
# Upper bounds for what is sent to every executor; both are measured before a broadcast.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 1024 * 1024


class HotGroups:
    """Groups above the row limit: at most ``rows / max_group_rows`` of them."""

    def __init__(self, keys: DataFrame, groups: Sequence[str], count: int, rows: int, total: int):
        self.groups = list(groups)
        self.count = count
        self.rows = rows
        self.everything = rows == total
        self.keys = F.broadcast(keys) if fits_broadcast(keys) else keys

    def condition(self, df: DataFrame) -> Column:
        return same_values(df, self.keys, {g: f"_hot_{g}" for g in self.groups})


def same_values(left: DataFrame, right: DataFrame, names: dict[str, str]) -> Column:
    """Null-safe equality of left and right columns."""
    return reduce(and_, [left[a].eqNullSafe(right[b]) for a, b in names.items()])


def hot_groups(
    df: DataFrame, groups: Sequence[str], max_group_rows: int = MAX_GROUP_ROWS
) -> HotGroups | None:
    """Find the large groups in one column-pruned pass; counts are combined before the shuffle. A table with no more rows
    than one group may have has none; for Parquet the footers tell."""
    if df.count() <= max_group_rows:
        return None
    seen = Observation()
    sizes = (
        df.groupBy(*[F.col(g).alias(f"_hot_{g}") for g in groups])
        .agg(F.count(F.lit(1)).alias("_rows"))
        .observe(seen, F.sum("_rows").alias("total"))
        .where(F.col("_rows") > max_group_rows)
    )
    sizes = materialize(sizes, "hot")
    found = sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("rows")).first()
    if not found["n"]:
        return None
    return HotGroups(sizes.drop("_rows"), groups, found["n"], found["rows"], seen.get["total"])


def ordered_position(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``row_number()`` over ``groups`` ordered by ``order``, without a task that holds a huge group.

    ``df`` is read more than once, so it must return the same rows each time (a scan, a written
    table). ``order`` must identify a row within its group.
    """
    window = Window.partitionBy(*groups).orderBy(*order)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, F.row_number().over(window).cast("bigint"))

    hot = hot_groups(df, groups, max_group_rows)
    if hot is None:
        return plain(df)
    if hot.everything:
        return _position_by_ranges(df, hot, order, name, max_group_rows)
    same = hot.condition(df)
    few = plain(df.join(hot.keys, same, "left_anti"))
    many = _position_by_ranges(df.join(hot.keys, same, "left_semi"), hot, order, name, max_group_rows)
    return few.unionByName(many)


def slices_of(rows: int, max_group_rows: int) -> int:
    """In how many ranges to cut groups that have ``rows`` in all: about half of ``max_group_rows`` in each, or MIN_SLICE_ROWS
    if that is more and there are MIN_SLICES of them."""
    return max(2, min(math.ceil(2 * rows / max_group_rows), max(MIN_SLICES, math.ceil(rows / MIN_SLICE_ROWS))))


def first_rows(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], n: int, name: str, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """The first ``n`` rows of each group, numbered in column ``name``.

    Spark keeps ``n`` rows per group in each input task before it shuffles (for large ``n`` it does not). Where
    the tasks together could still send one group more than ``max_group_rows`` rows, groups are cut in salted
    pieces first, so that neither step has a task with more rows of a group than that.
    """

    def cut(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)

    if n * MAX_TASKS <= max_group_rows:
        return cut(df, groups)
    if n > max_group_rows // 2:
        return ordered_position(df, groups, order, name, max_group_rows).where(F.col(name) <= n)
    salts = min(MAX_SALTS, max_group_rows // n)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    return cut(cut(salted, [*groups, "_salt"]).drop("_salt", name), groups)


def _position_by_ranges(
    df: DataFrame, hot: HotGroups, order: Sequence[str], name: str, max_group_rows: int
) -> DataFrame:
    """Sort into ranges, number within each range, then shift by what earlier ranges hold.

    The ranged rows are written first, so that slice numbers cannot change between their two uses.
    """
    groups = hot.groups
    slices = slices_of(hot.rows, max_group_rows)
    ranged = (
        df.repartitionByRange(slices, *groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("_slice", F.spark_partition_id())
        # The low 33 bits count the rows of a partition in their sorted order.
        .withColumn("_index", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    stored = materialize(ranged, "ranges")
    earlier = (
        Window.partitionBy(*[f"_run_{g}" for g in groups])
        .orderBy("_run_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per (range, group): at most slices + hot.count rows.
    runs = (
        stored.groupBy(F.col("_slice").alias("_run_slice"), *[F.col(g).alias(f"_run_{g}") for g in groups])
        .agg(F.min("_index").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1)
        .drop("_first", "_n")
    )
    runs = materialize(runs, "runs")
    if fits_broadcast(runs):
        runs = F.broadcast(runs)
    same = same_values(stored, runs, {g: f"_run_{g}" for g in groups})
    return (
        stored.join(runs, (stored["_slice"] == runs["_run_slice"]) & same)
        .withColumn(name, F.col("_index") + F.col("_shift"))
        .select(*df.columns, name)
    )


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a table: its rows, and if those are few enough its bytes."""
    if df.count() > max_rows:
        return False

    def width(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 16
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0)) + 16
        return F.lit(8)

    row = sum((width(f) for f in df.schema.fields), F.lit(16)).cast("bigint")
    return (df.agg(F.sum(row)).first()[0] or 0) <= max_bytes


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    how: str = "left",
    max_group_rows: int | None = MAX_GROUP_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    bound: DataFrame | None = None,
    stored: bool = False,
) -> DataFrame:
    """Join to a table that has one row per key; ``on`` maps left to right column names.

    A right side of proven small size is broadcast. Otherwise left rows of hot keys join against
    the broadcast right rows of just those keys, and all other rows take the shuffle join.
    ``how`` is left, inner, left_semi or left_anti. Left and right column names must differ.
    ``bound`` may be a table, cheaper to measure, that is at least as large as the right side.
    The split reads the left side three times; unless it is ``stored`` as a table already it is
    written first. ``max_group_rows=None`` says that no left key can be hot.
    """

    def condition(a: DataFrame, b: DataFrame) -> Column:
        return reduce(and_, [a[x] == b[y] for x, y in on.items()])

    small = fits_broadcast(right if bound is None else bound, broadcast_rows, broadcast_bytes)
    if small or left.isStreaming:
        other = F.broadcast(right) if small else right
        return left.join(other, condition(left, other), how)
    if max_group_rows is None:
        return left.join(right, condition(left, right), how)
    left = left if stored else materialize(left, "left")
    hot = hot_groups(left, list(on), max_group_rows)
    if hot is None:
        return left.join(right, condition(left, right), how)
    renamed = {f"_hot_{x}": y for x, y in on.items()}
    hot_right = right.join(
        hot.keys, reduce(and_, [right[y] == hot.keys[x] for x, y in renamed.items()]), "left_semi"
    )
    if fits_broadcast(hot_right):
        hot_right = F.broadcast(hot_right)
    hot_left = left.join(hot.keys, hot.condition(left), "left_semi")
    cold_left = left.join(hot.keys, hot.condition(left), "left_anti")
    return hot_left.join(hot_right, condition(hot_left, hot_right), how).unionByName(
        cold_left.join(right, condition(cold_left, right), how)
    )
