"""Exact top-k search by inner product, in tiles.

Vectors are packed into shards (candidates) and tiles (queries), one binary row each, in the smallest whole numbers that hold
them. Queries are gathered first, so their tiles are as few as their number allows, whatever the table's partitions. Only tiles are
copied: each is sent to every shard, and a shard stays in one place. A product of matrices scores a part of both, a partial selection
keeps the k best per query, and the short lists of all shards are merged in a tree, ``FAN_IN`` lists at a time.

Components are whole numbers, so scores are exact: products run in double precision while all sums stay
below 2^53, and in whole numbers of any size beyond that (scores outside the range of bigint are cut to it).

Vectors that are null, or hold a null or non-finite component, take no part, nor do rows without an id.
Only vectors of the same dimension meet. Equal scores go to the smaller id, then to the row that was
stored first. A row never meets itself; another row with the same id is a candidate like any other. An
empty table gives no rows. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import fits_broadcast
from millrace.session import materialize

QUERY_TILE = 4096
SHARD_ROWS = 32_768
FAN_IN = 16
# Parts of a tile and a shard that are scored at once.
ROWS, COLUMNS = 512, 4096
LIMIT = np.iinfo(np.int64)


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """row, id, v: floor(scale * x) of every component, for the vectors that take part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    usable = df.where(F.col(id_col).isNotNull() & x.isNotNull()).where(finite)
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint"))
    return usable.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), whole.alias("v"))


PACKED = "dim int, part bigint, n int, ids binary, rows binary, vectors binary"
PACKED_ARROW = pa.schema([("dim", pa.int32()), ("part", pa.int64()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("ids", "rows", "vectors")]])


def packed(vectors: DataFrame, most: int) -> DataFrame:
    """At most ``most`` vectors of one dimension per row, as matrices: as few rows as each partition allows."""

    def line(dim: int, part: int, pieces: list[list[np.ndarray]]) -> pa.RecordBatch:
        ids, rows, flat = (np.concatenate(c) for c in zip(*pieces))
        order = np.lexsort((rows, ids))
        matrix = flat.reshape(len(ids), dim)[order]
        values = [dim, part, len(ids), ids[order].tobytes(), rows[order].tobytes(), _smallest(matrix).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, PACKED_ARROW)], schema=PACKED_ARROW)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        waiting: dict[int, list[list[np.ndarray]]] = {}
        held: dict[int, int] = {}
        for batch in batches:
            ids, rows = batch["id"].to_numpy(), batch["row"].to_numpy()
            ends = batch["v"].offsets.to_numpy()
            flat, dims = batch["v"].values.to_numpy(zero_copy_only=False), np.diff(ends)
            for dim in np.unique(dims).tolist():
                which = np.flatnonzero(dims == dim)
                while len(which):
                    some, which = np.split(which, [most - held.get(dim, 0)])
                    numbers = flat[ends[some][:, None] + np.arange(dim)].ravel() if dim else np.empty(0, np.int64)
                    waiting.setdefault(dim, []).append([ids[some], rows[some], numbers])
                    held[dim] = held.get(dim, 0) + len(some)
                    if held[dim] == most:
                        yield line(dim, part, waiting.pop(dim))
                        part += 1
                        held[dim] = 0
            # Few rows of many dimensions are not kept waiting either.
            if sum(held.values()) > 2 * most:
                for dim in list(waiting):
                    yield line(dim, part, waiting.pop(dim))
                    part += 1
                held = {}
        for dim, pieces in waiting.items():
            yield line(dim, part, pieces)
            part += 1

    return vectors.mapInArrow(pack, PACKED)


def _smallest(matrix: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as the largest of them takes."""
    peak = _peak(matrix)
    for kind, limit in (("<i1", 2**7), ("<i2", 2**15), ("<i4", 2**31)):
        if peak < limit:
            return matrix.astype(kind)
    return matrix.astype("<i8")


def _matrix(n: int, dim: int, data: bytes) -> np.ndarray:
    width = len(data) // (n * dim) if n * dim else 8
    return np.frombuffer(data, dtype=f"<i{width}").reshape(n, dim).astype(np.int64)


def _peak(a: np.ndarray) -> int:
    return max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0


def best_of(q: np.ndarray, q_rows: np.ndarray, c: np.ndarray, c_ids: np.ndarray, c_rows: np.ndarray, k: int):
    """For each query the k best candidates, which are in order of id: (query index, candidate index, score)."""
    bound = _peak(q) * _peak(c) * max(1, q.shape[1])
    n = len(c)
    if bound * n < 2**53:
        # Score and place in one number: the larger, the better. All are whole and exact as doubles.
        key = (q.astype(np.float64) @ c.astype(np.float64).T) * n + np.arange(n - 1, -1, -1)
        own = -np.inf
    elif bound < 2**63:
        key, own = q @ c.T, None
    else:
        key, own = np.clip(q.astype(object) @ c.astype(object).T, LIMIT.min, LIMIT.max).astype(np.int64), None
    mine = q_rows[:, None] == c_rows[None, :]
    if own is not None:
        key[mine] = own
        top = np.argpartition(key, n - k, axis=1)[:, n - k :] if n > k else np.tile(np.arange(n), (len(q), 1))
    else:
        order = np.argsort(~key, axis=1, kind="stable")  # ~x is -x - 1 and cannot overflow
        first = order[:, : k + 1]
        top = first
    at = np.repeat(np.arange(len(q)), top.shape[1])
    to = top.ravel()
    keep = ~mine[at, to]
    at, to = at[keep], to[keep]
    score = np.floor_divide(key[at, to], n).astype(np.int64) if own is not None else key[at, to]
    return at, to, score


LISTS = "query_row bigint, query_id bigint, shard bigint, vec_id bigint, row bigint, score bigint"
LISTS_ARROW = pa.schema([(c, pa.int64()) for c in ("query_row", "query_id", "shard", "vec_id", "row", "score")])


def _first_k(query: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    order = np.lexsort((rows, ids, ~score, query))
    sorted_query = query[order]
    start = np.searchsorted(sorted_query, sorted_query, side="left")
    return order[np.arange(len(order)) - start < k]


def _score(k: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                dim = row["dim"]
                q, c = _matrix(row["q_n"], dim, row["q_vectors"]), _matrix(row["n"], dim, row["vectors"])
                q_ids, q_rows = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_rows"], "<i8")
                c_ids, c_rows = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["rows"], "<i8")
                for low in range(0, len(q), ROWS):
                    lists = []
                    for left in range(0, len(c), COLUMNS):
                        some, these = slice(low, low + ROWS), slice(left, left + COLUMNS)
                        at, to, value = best_of(q[some], q_rows[some], c[these], c_ids[these], c_rows[these], k)
                        lists.append((at + low, to + left, value))
                    at, to, value = (np.concatenate(x) for x in zip(*lists))
                    best = _first_k(at, value, c_ids[to], c_rows[to], k)
                    at, to, value = at[best], to[best], value[best]
                    shard = np.full(len(at), row["part"])
                    columns = [q_rows[at], q_ids[at], shard, c_ids[to], c_rows[to], value]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], schema=LISTS_ARROW)

    return score


def top_k(
    df: DataFrame, is_query: Column, k: int, scale: float, id_col: str = "vec_id", vector_col: str = "embedding",
    query_tile: int = QUERY_TILE, shard_rows: int = SHARD_ROWS, fan_in: int = FAN_IN,
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best candidates of each query row.

    ``is_query`` may use the column ``id``. Whatever the sizes, a task holds one tile and one shard at a time.
    """
    vectors = materialize(whole_vectors(df, id_col, vector_col, scale), "vectors")
    shards = materialize(packed(vectors, shard_rows), "shards")
    queries = vectors.where(is_query)
    gathered = queries.repartition(max(1, -(-queries.count() // query_tile)), F.xxhash64("row"))
    tiles = materialize(packed(gathered, query_tile), "tiles")
    # Which tile meets which shard is settled by their names; then tiles are sent there.
    names = shards.select("dim", "part")
    names = F.broadcast(names) if fits_broadcast(names) else names
    q = tiles.select(F.col("part").alias("tile"), F.col("dim").alias("q_dim"), *[F.col(c).alias(f"q_{c}") for c in ("n", "ids", "rows", "vectors")])
    sent = q.join(names, F.col("q_dim") == F.col("dim")).drop("dim", "q_dim", "tile")
    pairs = sent.join(shards, "part")
    lists = materialize(pairs.mapInArrow(_score(k), LISTS), "lists")
    best = [F.col("score").desc(), "vec_id", "row"]
    nodes = max(1, shards.count())
    while nodes > fan_in:
        nodes = -(-nodes // fan_in)
        lists = lists.withColumn("shard", F.pmod(F.xxhash64("shard"), F.lit(nodes)))
        window = Window.partitionBy("query_row", "shard").orderBy(*best)
        lists = lists.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= k).drop("_n")
    final = Window.partitionBy("query_row").orderBy(*best)
    ranked = lists.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
