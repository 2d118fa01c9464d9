"""Hard negatives by Fagin's threshold algorithm.

Vectors are range-partitioned by (dimension, label) into lanes and packed there, as shards: a matrix of whole numbers
and, per dimension, the list of its candidates sorted by that component. Anchors are packed in the same way into
tiles, which are sent to the lanes that can matter for them; a shard is never sent more than once.

For one anchor and one shard the lists are read in the order that the sign of the anchor's component asks for, from
the top or from the bottom, all dimensions in step. Each candidate met for the first time is scored in whole numbers.
No candidate that has not been met can score above the threshold, the anchor's product with the components just
read; once that is strictly below the worst score still wanted, the rest of the shard is left unread. That
score is the k-th best so far of a window, or the window's lower border while it has fewer.

Two searches run that way. The first finds an anchor's positives among the rows of its label, and its lists are merged; the
second looks for the negatives of all windows of an anchor at once, a window being the scores between ``low``
percent of a positive's score and that score itself.

Rows with a null id, label or vector, or a null or non-finite component, take no part. Only vectors of the same
dimension meet. Equal scores go to the smaller id, then to the row that was stored first; a row never meets itself, another
row with the same id is a candidate like any other, and each of several anchor rows with one id has rows of its own.
Scores are exact up to 2^62 of either sign and cut there. An empty table gives no rows. Only the id, the vector and the
label are read; labels are whole numbers.
"""

from __future__ import annotations

import math
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize

SHARD_ROWS = 16_384
TILE_ROWS = 256
# Steps of sorted access: the first reads so many entries of each list, every further one twice as many.
FIRST_STEP = 16
# Shards that a worker keeps ready for the next tile.
KEPT_SHARDS = 4
LIMIT = 2**62


def whole_vectors(df: DataFrame, scale: float, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """row, id, label, dim, v: floor(scale * x) of every component, for the rows that take part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    usable = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull()).where(finite)

    def whole(c: Column) -> Column:
        return F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint")

    return usable.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.size(x).alias("dim"),
        F.transform(x, whole).alias("v"),
    )


COLUMNS = ["dim", "lane", "part", "n", "low_label", "high_label", "labels", "ids", "rows", "vectors", "lists"]
PACKED = "dim int, lane int, part bigint, n int, low_label bigint, high_label bigint, labels binary, ids binary, rows binary, vectors binary, lists binary"
PACKED_ARROW = pa.schema(
    [
        ("dim", pa.int32()), ("lane", pa.int32()), ("part", pa.int64()), ("n", pa.int32()), ("low_label", pa.int64()),
        ("high_label", pa.int64()), *[(c, pa.binary()) for c in ("labels", "ids", "rows", "vectors", "lists")],
    ]
)


def packed(vectors: DataFrame, most: int, with_lists: bool) -> DataFrame:
    """Matrices of at most ``most`` rows, of neighbours in (dim, label). Their number follows the number of rows,
    whatever the partitions were before."""
    lanes = max(1, math.ceil(vectors.count() / most))
    placed = vectors.repartitionByRange(lanes, "dim", "label", F.xxhash64("id", "row"), "row").sortWithinPartitions("dim", "label", "id", "row")

    def line(dim: int, lane: int, part: int, labels, ids, rows, flat) -> pa.RecordBatch:
        v = flat.reshape(len(ids), dim)
        small = np.int16 if not v.size or (v.min() >= -(2**15) and v.max() < 2**15) else np.int64
        lists = np.argsort(v, axis=0, kind="stable").T.astype(_place_type(len(ids))).tobytes() if with_lists else b""
        values = [
            dim, lane, part, len(ids), int(labels.min()), int(labels.max()), labels.tobytes(), ids.tobytes(), rows.tobytes(),
            v.astype(small).tobytes(), lists,
        ]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, PACKED_ARROW)], schema=PACKED_ARROW)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = TaskContext.get().partitionId()
        part = lane << 32
        waiting: list[list[np.ndarray]] = []
        held, dim = 0, None

        def flush() -> pa.RecordBatch:
            return line(dim, lane, part, *(np.concatenate(c) for c in zip(*waiting)))

        for batch in batches:
            labels, ids, rows, dims = (batch[c].to_numpy() for c in ("label", "id", "row", "dim"))
            ends = batch["v"].offsets.to_numpy()
            flat = batch["v"].values.to_numpy(zero_copy_only=False)
            at = 0
            while at < len(ids):
                if held and (dims[at] != dim or held == most):
                    yield flush()
                    waiting, held, part = [], 0, part + 1
                dim = int(dims[at])
                same = np.flatnonzero(dims[at:] != dim)
                to = min(at + most - held, at + int(same[0]) if len(same) else len(ids))
                waiting.append([labels[at:to], ids[at:to], rows[at:to], flat[ends[at] : ends[to]]])
                held += to - at
                at = to
        if held:
            yield flush()

    return placed.mapInArrow(pack, PACKED)


def _place_type(n: int) -> str:
    return "<u2" if n <= 2**16 else "<u4"


def matrix(n: int, dim: int, data) -> np.ndarray:
    width = "<i2" if len(data) == 2 * n * dim else "<i8"
    return np.frombuffer(data, width).reshape(n, dim).astype(np.int64)


def _peak(a: np.ndarray) -> int:
    return max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0


class Shard:
    """Candidates with one sorted list per dimension."""

    def __init__(self, dim: int, n: int, labels, ids, rows, vectors, lists):
        self.n, self.dim = n, dim
        self.labels, self.ids, self.rows = (np.frombuffer(x, "<i8") for x in (labels, ids, rows))
        self.v = matrix(n, dim, vectors)
        self.lists = np.frombuffer(lists, _place_type(n)).reshape(dim, n)
        self.peak = _peak(self.v)
        self.as_double = self.v.astype(np.float64)

    def scores(self, anchor: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Whole products; in double precision while all sums stay below 2^53."""
        if self.dim * self.peak * _peak(anchor) < 2**53:
            return (self.as_double[which] @ anchor.astype(np.float64)).astype(np.int64)
        return np.clip(self.v[which].astype(object) @ anchor.astype(object), -LIMIT, LIMIT).astype(np.int64)

    def threshold_search(self, anchor: np.ndarray, wanted: np.ndarray, floors: list, ceilings: list, k: int, first_step: int = FIRST_STEP):
        """For each window [floor, ceiling] its ``k`` best among the candidates marked in ``wanted``: lists of (score,
        place), and how many entries of a list were read."""
        windows = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in floors]
        used = np.flatnonzero(anchor)
        unseen = wanted.copy()
        # Signed access: from the largest component down where the anchor's is positive, else from the smallest up.
        down = anchor[used] > 0
        depth, step = 0, first_step
        while depth < self.n:
            to = min(self.n, depth + step)
            if len(used):
                at = np.where(down[:, None], np.arange(self.n - 1 - depth, self.n - 1 - to, -1), np.arange(depth, to))
                met = self.lists[used[:, None], at]
                threshold = sum(int(a) * int(x) for a, x in zip(anchor[used], self.v[met[:, -1], used]))
                fresh = np.zeros(self.n, bool)
                fresh[met.ravel()] = True
                places = np.flatnonzero(fresh & unseen)
            else:
                # Nothing to sort by: every product is zero.
                to, threshold, places = self.n, 0, np.flatnonzero(unseen)
            unseen[places] = False
            if len(places):
                score = self.scores(anchor, places)
                windows = [
                    self.best(*kept, score, places, low, high, k) for kept, low, high in zip(windows, floors, ceilings)
                ]
            depth, step = to, 2 * step
            bars = [score[-1] if len(score) == k else low for (score, _), low in zip(windows, floors)]
            if all(bar is not None and threshold < bar for bar in bars) or not unseen.any():
                break
        return windows, depth

    def best(self, score, places, more_score, more_places, low, high, k: int):
        fits = np.ones(len(more_score), bool)
        if low is not None:
            fits &= more_score >= low
        if high is not None:
            fits &= more_score <= high
        if len(score) == k:
            fits &= more_score >= score[-1]
        if not fits.any():
            return score, places
        score = np.concatenate([score, more_score[fits]])
        places = np.concatenate([places, more_places[fits]])
        order = np.lexsort((self.rows[places], self.ids[places], -score))[:k]
        return score[order], places[order]


_ready: OrderedDict[tuple, Shard] = OrderedDict()


def _shard(run: str, row: dict) -> Shard:
    """Tiles that follow each other meet the same shards."""
    key = (run, row["part"].as_py())
    if key not in _ready:
        while len(_ready) >= KEPT_SHARDS:
            _ready.popitem(last=False)
        data = [row[c].as_buffer().to_pybytes() for c in ("labels", "ids", "rows", "vectors", "lists")]
        _ready[key] = Shard(row["dim"].as_py(), row["n"].as_py(), *data)
    return _ready[key]


FOUND_COLUMNS = ["tile", "place", "anchor_row", "anchor_id", "slot", "row", "id", "score"]
FOUND = ", ".join(f"{c} bigint" for c in FOUND_COLUMNS)
FOUND_ARROW = pa.schema([(c, pa.int64()) for c in FOUND_COLUMNS])


def _search(k: int, low_percent: int, run: str, first_step: int):
    """Tile x shard to the best of each anchor's windows. Without windows it looks for positives."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i] for c in batch.schema.names}
                shard, count = _shard(run, row), row["a_n"].as_py()
                anchors = matrix(count, shard.dim, row["a_vectors"].as_buffer().to_pybytes())
                labels, ids, rows = (np.frombuffer(row[c].as_buffer().to_pybytes(), "<i8") for c in ("a_labels", "a_ids", "a_rows"))
                windows = np.frombuffer(row["windows"].as_buffer().to_pybytes(), "<i8").reshape(count, -1) if "windows" in row else None
                out = []
                for j in range(count):
                    same = shard.labels == labels[j]
                    if windows is None:
                        wanted = same & (shard.rows != rows[j])
                        floors, ceilings, slots = [None], [None], [0]
                    else:
                        wanted = ~same
                        own = [int(score) for score in windows[j][1 : 1 + windows[j][0]]]
                        lowest = [-(-low_percent * score // 100) for score in own]
                        # A negative score has no window: 80 percent of it is more than all of it.
                        slots = [s for s in range(len(own)) if lowest[s] <= own[s]]
                        floors, ceilings = [lowest[s] for s in slots], [own[s] for s in slots]
                    if not slots or not wanted.any():
                        continue
                    found, _ = shard.threshold_search(anchors[j], wanted, floors, ceilings, k, first_step)
                    for slot, (score, places) in zip(slots, found):
                        m = len(places)
                        if m:
                            head = [np.full(m, x) for x in (row["a_part"].as_py(), j, rows[j], ids[j], slot)]
                            out.append([*head, shard.rows[places], shard.ids[places], score])
                if out:
                    columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=FOUND_ARROW)

    return search


def _meet(tiles: DataFrame, shards: DataFrame, condition: Column) -> DataFrame:
    """Each tile beside each shard of the lanes that matter for it. Which these are is found by names alone; then a tile is sent
    to its lanes, and a lane's shards stay where they are."""
    ranges = shards.groupBy("lane", "dim").agg(F.min("low_label").alias("low"), F.max("high_label").alias("high"))
    ranges = ranges.withColumnRenamed("dim", "l_dim")
    lanes = 1 + (shards.agg(F.max("lane")).first()[0] or 0)
    names = tiles.select("part", "dim", "low_label", "high_label", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("a_lane"))
    wanted = names.join(ranges, (F.col("a_lane") == F.col("lane")) & (F.col("dim") == F.col("l_dim"))).where(condition)
    wanted = wanted.select(F.col("part").alias("a_part"), "lane")
    tiles = tiles.select(F.col("part").alias("a_part"), F.col("dim").alias("a_dim"), *_tile_columns(tiles))
    sent = tiles.join(wanted.hint("shuffle_hash"), "a_part")
    # The tiles stream past the few shards of their lane.
    met = sent.join(shards.drop("low_label", "high_label"), "lane")
    return met.where(F.col("a_dim") == F.col("dim")).drop("a_dim", "lane")


def _tile_columns(tiles: DataFrame) -> list[Column]:
    own = [F.col(c).alias(f"a_{c}") for c in ("n", "labels", "ids", "rows", "vectors")]
    return [*own, *([F.col("windows")] if "windows" in tiles.columns else [])]


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _with_windows(positives: int):
    """A tile with the scores of each anchor's positives beside it: their number, then the scores by rank."""

    def add(tile: pa.Table, chosen: pa.Table) -> pa.Table:
        if not tile.num_rows:
            return tile.append_column("windows", pa.array([], pa.binary()))
        lines = np.zeros((tile["n"][0].as_py(), 1 + positives), np.int64)
        place, rank = chosen["place"].to_numpy(), chosen["rank"].to_numpy()
        lines[place, rank] = chosen["score"].to_numpy()
        np.maximum.at(lines[:, 0], place, rank)
        return tile.append_column("windows", pa.array([lines.tobytes()], pa.binary()))

    return add


def _k_best(found: DataFrame, k: int) -> DataFrame:
    """The best of all shards; Spark keeps k of each window per input task before it shuffles."""
    window = Window.partitionBy("anchor_row", "slot").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, scale: float = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    shard_rows: int = SHARD_ROWS, tile_rows: int = TILE_ROWS, first_step: int = FIRST_STEP,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Positives are the best rows of the anchor's label; negatives the best of other labels among those whose score is
    at least ``low_percent`` percent of the positive's and no higher. ``is_anchor`` may use the column ``id``.
    """
    run = uuid.uuid4().hex
    vectors = materialize(whole_vectors(df, scale, id_col, vector_col, label_col), "vectors")
    shards = materialize(packed(vectors, shard_rows, True), "shards")
    tiles = materialize(packed(vectors.where(is_anchor), tile_rows, False).drop("lists", "lane"), "tiles")
    overlap = (F.col("low_label") <= F.col("high")) & (F.col("high_label") >= F.col("low"))
    near = _meet(tiles, shards, overlap).mapInArrow(_search(positives, low_percent, run, first_step), FOUND)
    chosen = materialize(_k_best(near, positives), "positives")

    windows = tiles.groupBy("part").cogroup(chosen.select("tile", "place", "rank", "score").groupBy("tile"))
    tiles = materialize(windows.applyInArrow(_with_windows(positives), _ddl(tiles) + ", windows binary"), "windows")
    other = (F.col("low_label") != F.col("high_label")) | (F.col("low") != F.col("high")) | (F.col("low_label") != F.col("low"))
    far = _meet(tiles, shards, other).mapInArrow(_search(negatives, low_percent, run, first_step), FOUND)
    best = _k_best(materialize(far, "negatives"), negatives)
    pairs = chosen.select(
        "anchor_row", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return best.join(pairs, ["anchor_row", "slot"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
