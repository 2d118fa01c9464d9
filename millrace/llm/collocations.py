"""Phrase collocations by direct-address tiling.

Words that occur often enough get ids by falling frequency, so the first ids hold most of the text. Texts become
sequences of ids with gaps at the borders of pieces and at rare words. Neighbours in a sequence are pairs of
ids; a task gathers them, cuts the plane of pairs into square tiles and counts a dense tile with one
``bincount`` over its cells, a sparse one by sorted coordinates. The partial counts are added up by Spark. Pairs
that are frequent get ids by falling frequency of their own, sequences are rewritten as ids of pairs, and the same
step counts phrases one word longer: a phrase is frequent only if both phrases it is made of are, hence
nothing is lost by the gaps.

Ids span all languages, so an id tells its language. Lists of ids are sent to the tasks in slices of at most
``SLICE`` entries, each in a pass of its own over what the passes before left open; with one slice it is one pass.

Null and empty texts have no words; a null language counts as ``und``. Texts are taken whole; repeated rows count
as often as they occur. Ties are settled by the phrase. An empty table gives no rows. Only the text and the
language are read, long texts in slices. Counts are whole numbers; scores are worked out in whole numbers of 38 digits, hence exact while
``scale * a * n`` has no more.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import MAX_GROUP_ROWS, first_rows, ordered_position
from millrace.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = ".,;:!?\n\x0b\x0c\r"
# Ids that a task holds at once, side of a tile, and pairs that are counted together.
SLICE = 1_000_000
TILE = 1024
BUFFER_PAIRS = 2_000_000
# Counted pairs that a task hands on at once.
PAIR_ROWS = 100_000
# A tile is counted densely if it holds one pair for this many cells.
CELLS_PER_PAIR = 16
# Different words that a task counts at once.
COUNTED_WORDS = 500_000
# Ids in one row of a sequence table, but for longer texts: few enough that a heap of ordinary size has no trouble with a row.
ROW_IDS = 100_000
GAP, OPEN = -1, -2

SEQUENCES = "ids binary, open binary"
SEQUENCES_ARROW = pa.schema([("ids", pa.binary()), ("open", pa.binary())])


_BYTES = bytes.maketrans((UPPER + BREAKS + "\t").encode(), (LOWER + "\n" * len(BREAKS) + " ").encode())


def words_of(text: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, with a line end between pieces; long texts in slices that end with a word."""
    text = text.translate(_BYTES)
    low = 0
    while low < len(text):
        ends = [e for e in (text.find(b" ", low + most), text.find(b"\n", low + most)) if e >= 0] if len(text) - low > most else []
        high = min(ends, default=len(text))
        yield [w for w in text[low:high].replace(b"\n", b" \n ").split(b" ") if w]
        low = high


COUNTS_ARROW = pa.schema([("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.col(text_col).alias("text")).where(F.length("text") > 0)


def word_counts(docs: DataFrame, text_col: str, lang_col: str, most: int = COUNTED_WORDS) -> DataFrame:
    """lang, word, f of every word. A task counts up to ``most`` different words before it hands them on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in found.items():
                counts.pop(b"\n", None)
                words = pa.array(list(counts), pa.binary()).cast(pa.string())
                columns = [pa.array([lang] * len(words), pa.string()), words, pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=COUNTS_ARROW)

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                counts = found.setdefault(lang, Counter())
                for words in words_of(text.as_buffer().to_pybytes()):
                    before = len(counts)
                    counts.update(words)
                    size += len(counts) - before
                    if size > most:
                        yield from flush()
                        found, size = {lang: Counter()}, 0
                        counts = found[lang]
        yield from flush()

    partial = _texts(docs, text_col, lang_col).mapInArrow(count, "lang string, word string, f bigint")
    return partial.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def ranked(counts: DataFrame, tie: list[str], label: str, most: int = MAX_GROUP_ROWS) -> DataFrame:
    """``id`` from 0 by falling ``f``: one sort of up to ``most`` rows, range partitions beyond that."""
    counts = materialize(counts.withColumn("_all", F.lit(0)).withColumn("_less", -F.col("f")), label)
    if counts.count() <= most:
        numbered = counts.withColumn("id", F.row_number().over(Window.partitionBy("_all").orderBy("_less", *tie)).cast("bigint"))
    else:
        numbered = ordered_position(counts, ["_all"], ["_less", *tie], "id", most)
    return materialize(numbered.withColumn("id", F.col("id") - 1).drop("_all", "_less"), f"{label}-ranked")


def _slices(table: DataFrame, names: list[str], most: int):
    """The table in slices by id, each small enough for every task."""
    count = table.count()
    for low in range(0, count, most):
        part = table.where((F.col("id") >= low) & (F.col("id") < low + most)).select(*names, "id")
        yield part.toArrow(), low + most >= count


def _rows(ids: list[np.ndarray], rest: list[bytes] | None = None) -> Iterator[pa.RecordBatch]:
    """Sequences one after the other in rows of bounded size, with a gap between them."""
    line, left, size = [], [], 0
    for i, part in enumerate(ids):
        line.append(part)
        left.append(rest[i] if rest is not None else b"")
        size += len(part)
        if size >= ROW_IDS or i == len(ids) - 1:
            data = np.concatenate(line).astype("<i4").tobytes()
            open_words = b" ".join(x for x in left if x)
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary()), pa.array([open_words], pa.binary())], schema=SEQUENCES_ARROW)
            line, left, size = [], [], 0


def closed(ids: np.ndarray) -> np.ndarray:
    """A sequence without what cannot be part of a pair: repeated gaps, and ids between two gaps."""
    ids = np.where(ids < 0, GAP, ids)
    around = np.r_[GAP, ids, GAP]
    keep = (ids >= 0) & ((around[:-2] >= 0) | (around[2:] >= 0))
    # One gap is kept after each run.
    keep |= (ids < 0) & np.r_[False, keep[:-1]]
    return ids[keep]


def _named(lang: str, word: bytes) -> bytes:
    """A word with its language, without white space whatever the language is called."""
    return lang.encode().hex().encode() + b"\t" + word


def _ids_by_lang(table: pa.Table) -> dict[str, dict[bytes, int]]:
    by_lang: dict[str, dict[bytes, int]] = {}
    for lang, word, number in zip(*(table[c].to_pylist() for c in ("lang", "word", "id"))):
        by_lang.setdefault(lang, {})[word.encode()] = number
    return by_lang


def word_sequences(docs: DataFrame, vocabulary: DataFrame, text_col: str, lang_col: str, most: int = SLICE) -> DataFrame:
    """Texts as ids of frequent words."""
    spark = docs.sparkSession
    texts = _texts(docs, text_col, lang_col)
    done = None
    for table, last in _slices(vocabulary, ["lang", "word"], most):
        if done is None:
            known = spark.sparkContext.broadcast(_ids_by_lang(table))
            done = texts.mapInArrow(_first_pass(known, last), SEQUENCES)
        else:
            words = [_named(a, b.encode()) for a, b in zip(table["lang"].to_pylist(), table["word"].to_pylist())]
            known = spark.sparkContext.broadcast(dict(zip(words, table["id"].to_pylist())))
            done = done.mapInArrow(_next_pass(known, last), SEQUENCES)
        done = materialize(done, "word-ids")
    return done if done is not None else spark.createDataFrame([], SEQUENCES)


def _first_pass(known, last: bool):
    """Texts against the first slice; words that are not in it stay open if more slices follow."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang = known.value
        for batch in batches:
            ids, rest, size = [], [], 0
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                ids_of = by_lang.get(lang, {})
                whole, left = [], []
                for words in words_of(text.as_buffer().to_pybytes()):
                    if last:
                        line = np.fromiter((ids_of.get(w, GAP) for w in words), np.int64, len(words))
                    else:
                        line = np.fromiter((GAP if w == b"\n" else ids_of.get(w, OPEN) for w in words), np.int64, len(words))
                        left += [_named(lang, words[i]) for i in np.flatnonzero(line == OPEN)]
                    whole.append(line)
                # A text stays in one row, with a gap after it; what cannot be part of a pair goes once the whole text is there.
                ids.append(np.concatenate([*whole, [GAP]]))
                rest.append(b" ".join(left))
                size += len(ids[-1])
                if size >= ROW_IDS:
                    yield from _rows([closed(np.concatenate(ids))] if last else ids, rest if not last else None)
                    ids, rest, size = [], [], 0
            if last and ids:
                ids = [closed(np.concatenate(ids))]
            yield from _rows(ids, rest if not last else None)

    return encode


def _next_pass(known, last: bool):
    """What is still open against the next slice."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = known.value
        for batch in batches:
            for data, words in zip(batch["ids"].to_pylist(), batch["open"].to_pylist()):
                ids = np.frombuffer(data, "<i4").astype(np.int64)
                words = words.split(b" ") if words else []
                found = np.fromiter((ids_of.get(w, OPEN) for w in words), np.int64, len(words))
                ids[ids == OPEN] = found
                rest = b"" if last else b" ".join([words[i] for i in np.flatnonzero(found == OPEN)])
                yield from _rows([closed(ids) if last else ids], [rest])

    return encode


def count_tiles(first: np.ndarray, second: np.ndarray, tile: int = TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and how often each occurs: dense tiles by direct address, sparse ones by sorted coordinates. Arrays are
    of 32 bits where the numbers allow, and dropped as soon as the next step has what it needs."""
    columns = int(second.max()) // tile + 1
    tiles = (int(first.max()) // tile + 1) * columns
    kind = np.int32 if max(tiles, tile * tile, int(first.max()), int(second.max())) < 1 << 31 else np.int64
    place, cell = (first // tile).astype(kind), (first % tile).astype(kind)
    place *= columns
    place += second // tile
    cell *= tile
    cell += second % tile
    del first, second
    order = np.argsort(place)
    place = place[order]
    cell = cell[order]
    del order
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    ends = np.r_[starts[1:], len(place)]
    dense = (ends - starts) * CELLS_PER_PAIR >= tile * tile
    found = []
    for low, high in zip(starts[dense].tolist(), ends[dense].tolist()):
        table = np.bincount(cell[low:high], minlength=tile * tile)
        hit = np.flatnonzero(table)
        found.append((np.full(len(hit), place[low]), hit.astype(kind), table[hit].astype(kind)))
    if not dense.all():
        # All sparse tiles together as one sorted list of coordinates.
        rest = np.repeat(~dense, ends - starts)
        code = place[rest].astype(np.int64)
        code *= tile * tile
        code += cell[rest]
        del place, cell, rest
        code.sort()
        at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        n = np.empty(len(at), kind)
        n[:-1] = at[1:] - at[:-1]
        n[-1] = len(code) - at[-1]
        code = code[at]
        del at
        found.append(((code // (tile * tile)).astype(kind), (code % (tile * tile)).astype(kind), n))
        del code, n
    place, cell, n = found[0] if len(found) == 1 else (np.concatenate(x) for x in zip(*found))
    del found
    return (place // columns) * tile + cell // tile, (place % columns) * tile + cell % tile, n


PAIRS = "first bigint, second bigint, f bigint"
PAIRS_ARROW = pa.schema([(c, pa.int64()) for c in ("first", "second", "f")])


def pair_counts(sequences: DataFrame, min_count: int, tile: int = TILE, buffer: int = BUFFER_PAIRS) -> DataFrame:
    """first, second, f of all neighbours that occur often enough."""
    partial = sequences.select("ids").mapInArrow(_count_pairs(tile, buffer), PAIRS)
    return partial.groupBy("first", "second").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def _count_pairs(tile: int, buffer: int):
    """Counts of the pairs of ``buffer`` ids at a time, in batches of at most ``PAIR_ROWS``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate([*waiting, np.array([GAP], np.int32)])
            waiting.clear()
            near = (ids[:-1] >= 0) & (ids[1:] >= 0)
            if near.any():
                columns = count_tiles(ids[:-1][near], ids[1:][near], tile)
                del ids, near
                for low in range(0, len(columns[0]), PAIR_ROWS):
                    part = [pa.array(c[low : low + PAIR_ROWS].astype(np.int64)) for c in columns]
                    yield pa.RecordBatch.from_arrays(part, schema=PAIRS_ARROW)

        for batch in batches:
            for data in batch["ids"]:
                ids = np.frombuffer(data.as_buffer(), "<i4")
                for low in range(0, len(ids), buffer):
                    # One id more, so that the pair across the cut is not lost. A copy, so that the batch can go.
                    part = ids[low : low + buffer + 1].astype(np.int32)
                    waiting += [part, np.array([GAP], np.int32)]
                    size += len(part)
                    if size >= buffer:
                        yield from flush()
                        size = 0
        if waiting:
            yield from flush()

    return count


def _recode(known, last: bool):
    """Neighbours of ids to ids of pairs; ``open`` holds the ids themselves while slices are to come."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, number, width = known.value
        for batch in batches:
            for data, before in zip(batch["ids"], batch["open"]):
                start = np.frombuffer(data.as_buffer(), "<i4").astype(np.int64)
                first_pass = len(before.as_buffer()) == 0
                ids = start if first_pass else np.frombuffer(before.as_buffer(), "<i4").astype(np.int64)
                out = np.full(len(ids), GAP, np.int64) if first_pass else start
                if len(ids) > 1 and len(code):
                    key = np.where((ids[:-1] >= 0) & (ids[1:] >= 0) & (ids[:-1] < width), ids[:-1], -1)
                    key = np.where(key >= 0, key * width + ids[1:], -1)
                    at = np.minimum(np.searchsorted(code, key), len(code) - 1)
                    out[:-1] = np.where(code[at] == key, number[at], out[:-1])
                if last:
                    yield from _rows([closed(np.r_[out, GAP])])
                else:
                    yield from _rows([out], [ids.astype("<i4").tobytes()])

    return encode


def pair_sequences(sequences: DataFrame, pairs: DataFrame, width: int, most: int = SLICE) -> DataFrame:
    """Sequences of ids as sequences of the ids of their frequent pairs. ``width`` is above every id."""
    spark = sequences.sparkSession
    for table, last in _slices(pairs, ["first", "second"], most):
        first, second, number = (table[c].to_numpy() for c in ("first", "second", "id"))
        code = first * max(width, 1) + second
        order = np.argsort(code)
        known = spark.sparkContext.broadcast((code[order], number[order], width))
        sequences = materialize(sequences.mapInArrow(_recode(known, last), SEQUENCES), "pair-ids")
    return sequences


def _phrases(pairs: DataFrame, shorter: DataFrame) -> DataFrame:
    """Pairs of phrases as phrases: words, and how often each beginning and each end occurs (``heads`` and
    ``tails``, by falling cut: the first k words, and the rest after k words)."""
    left = shorter.select(F.col("id").alias("first"), "lang", F.col("words").alias("_a"), F.col("heads").alias("_ah"), F.col("f").alias("_af"))
    right = shorter.select(F.col("id").alias("second"), F.col("words").alias("_b"), F.col("tails").alias("_bt"), F.col("f").alias("_bf"))
    joined = pairs.join(left, "first").join(right, "second")
    return joined.select(
        "id",
        "first",
        "second",
        "lang",
        F.concat("_a", F.slice("_b", -1, 1)).alias("words"),
        "f",
        F.concat("_ah", F.array("_af")).alias("heads"),
        F.concat(F.array("_bf"), "_bt").alias("tails"),
    )


def collocations(
    docs: DataFrame, min_count: int = 100, max_words: int = 5, top: int = 2000, scale: int = 1000, share: int = 100,
    text_col: str = "text", lang_col: str = "lang", slice_ids: int = SLICE, tile: int = TILE, buffer: int = BUFFER_PAIRS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases per language.

    A candidate is a phrase of 2 to ``max_words`` words that occurs ``min_count`` times. Its score is the
    least over its cuts of ``floor(scale * a * n / (l * r))``. Candidates of which a longer one has at least ``share`` percent
    of the occurrences are left out.
    """
    if max_words < 2:
        raise ValueError("a phrase has two words at least")
    counts = materialize(word_counts(docs, text_col, lang_col), "words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    vocabulary = ranked(counts.where(F.col("f") >= min_count), ["lang", "word"], "vocabulary")
    none = F.array().cast("array<bigint>")
    level = vocabulary.select("id", "lang", F.array("word").alias("words"), "f", none.alias("heads"), none.alias("tails"))
    width = vocabulary.count()
    sequences = word_sequences(docs, vocabulary, text_col, lang_col, slice_ids)
    levels = []
    for length in range(2, max_words + 1):
        pairs = ranked(pair_counts(sequences, min_count, tile, buffer), ["first", "second"], f"pairs-{length}")
        found = pairs.count()
        if not found:
            break
        level = materialize(_phrases(pairs, level), f"phrases-{length}")
        levels.append(level)
        if length < max_words:
            sequences = pair_sequences(sequences, pairs, width, slice_ids)
            width = found

    kept = []
    for i, level in enumerate(levels):
        if i + 1 < len(levels):
            # A longer phrase that holds this one and is as frequent implies one that is longer by a word.
            longer = levels[i + 1]
            longer = longer.select(F.col("first").alias("id"), F.col("f").alias("_f")).unionByName(
                longer.select(F.col("second").alias("id"), F.col("f").alias("_f"))
            )
            most = longer.groupBy("id").agg(F.max("_f").alias("_f"))
            level = level.join(most, "id", "left").where(F.col("_f").isNull() | (100 * F.col("_f") < share * F.col("f")))
        kept.append(level.select("lang", "words", "f", "heads", "tails"))
    if not kept:
        kept = [level.select("lang", "words", "f", "heads", "tails").where(F.lit(False))]
    candidates = reduce(DataFrame.unionByName, kept).join(totals, "lang")

    def exact(column: str) -> str:
        return f"CAST({column} AS DECIMAL(19, 0))"

    def score(head: str, tail: str) -> str:
        return f"(CAST({scale} AS DECIMAL(10, 0)) * {exact('f')} * {exact('n')}) div ({exact(head)} * {exact(tail)})"

    # The least score comes first, then the smallest cut.
    cuts = F.expr(
        "array_min(transform(arrays_zip(heads, tails), (c, i) -> struct("
        f"{score('c.heads', 'c.tails')} AS score, i AS cut, c.heads AS l, c.tails AS r)))"
    )
    scored = candidates.withColumn("_cut", cuts).select(
        "lang",
        F.array_join("words", " ").alias("phrase"),
        F.col("f").alias("a"),
        "_cut.l",
        "_cut.r",
        "n",
        F.col("_cut.score").cast("bigint").alias("score"),
    )
    # Candidates of one language are cut in salted pieces first, so that no task sorts them all.
    falling = scored.withColumns({"_score": -F.col("score"), "_a": -F.col("a")})
    best = first_rows(materialize(falling, "scored"), ["lang"], ["_score", "_a", "phrase"], top, "rank")
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
