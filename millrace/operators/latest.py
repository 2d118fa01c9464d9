"""The current document of each key, and fetching documents by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import join_unique


def newest_struct(version: Sequence[str], fields: Sequence[str]) -> Column:
    """A struct whose maximum is the newest version; the other fields follow and settle ties."""
    return F.struct(*version, *[f for f in fields if f not in version])


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: Sequence[str], fields: Sequence[str] | None = None
) -> DataFrame:
    """Last write per key wins; ``version`` columns are compared in order. Without a version the
    row that is greatest by value is kept.

    One shuffle; each input task first reduces its rows to one per key, so a hot key stays small.
    Rows without a key or a leading version belong in quarantine and are not considered.
    """
    fields = list(fields) if fields is not None else [c for c in df.columns if c not in keys]
    usable = reduce(and_, [F.col(c).isNotNull() for c in [*keys, *version[:1]]])
    best = F.max(newest_struct(version, fields)).alias("_best")
    return (
        df.where(usable)
        .groupBy(*keys)
        .agg(best)
        .select(*keys, *[F.col("_best")[f].alias(f) for f in fields])
    )


def lookup_by_keys(
    docs: DataFrame,
    wanted: DataFrame,
    key: str,
    version: Sequence[str],
    wanted_key: str | None = None,
) -> DataFrame:
    """Current documents for a set of keys, in one join instead of one query per key.

    Documents of other keys are left out before the newest of each key is looked for.
    """
    named = wanted.select(F.col(wanted_key or key).alias("_wanted")).where("_wanted IS NOT NULL")
    # A key with many documents is split by adaptive execution, which may cut the left side of a semi-join.
    found = join_unique(docs, named.distinct(), {key: "_wanted"}, "left_semi", max_group_rows=None, bound=named)
    return latest_per_key(found, [key], version)
