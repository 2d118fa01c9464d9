"""Reduce rows before a stateful operator's shuffle.

Spark has no map-side combine for ``transformWithState``. These functions shrink each Arrow batch to
what can still matter, so that a key with a third of all rows sends a few rows per batch, not all.
Per batch means memory stays bounded whatever the number of keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

Batches = Iterator[pa.RecordBatch]


def first_seen(batches: Batches) -> Batches:
    """(key, source, commit_ts) to one row per key and source: earliest and latest time, arrivals."""
    for batch in batches:
        grouped = (
            pa.Table.from_batches([batch])
            .group_by(["key", "source"])
            .aggregate([("commit_ts", "min"), ("commit_ts", "max"), ("commit_ts", "count")])
        )
        table = pa.table(
            {
                "key": grouped["key"],
                "source": grouped["source"],
                "first_ts": grouped["commit_ts_min"],
                "last_ts": grouped["commit_ts_max"],
                "arrivals": grouped["commit_ts_count"],
            }
        )
        yield from table.to_batches()


def _run_ranks(keys: pa.ChunkedArray) -> pa.Array:
    """Rank within runs of equal neighbours, from 0."""
    import numpy as np

    codes = keys.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    lengths = np.diff(np.r_[starts, len(codes)])
    return pa.array(np.arange(len(codes)) - np.repeat(starts, lengths))


def earliest(n: int) -> Callable[[Batches], Batches]:
    """Keep the ``n`` earliest arrivals of each key; later ones cannot be the n-th."""

    def reduce(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch]).sort_by(
                    [("key", "ascending"), ("commit_ts", "ascending"), ("seq", "ascending")]
                )
                yield from table.filter(pc.less(_run_ranks(table["key"]), n)).to_batches()

    return reduce
