"""Best-fit packing of tokenized documents by the sum-of-squares rule.

Among the open sequences that have room, a piece goes where the sum over all gaps of the squared number
of open sequences with that gap becomes smallest; a new one is opened when none has room. Sequences with
the same gap do not pile up, and taken longest first nearly all get filled to the end.

``tokenize`` cuts documents into pieces, ``pack`` places pieces. Placing is sequential, so pieces are
dealt over groups of bounded size by a hash of the piece, and every group is packed by itself: a
group costs at most a few partly filled sequences. No group depends on the size of a source or a key.

Null and empty texts are one piece that holds the end token alone. Texts of any length are tokenized
whole. Repeated rows are packed as often as they occur. An empty table gives no rows. Only the id and
the text column are read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytelevel import ALPHABET
from millrace.llm.memory import forget_others, remembers
from millrace.session import materialize

# Pieces that one task packs in sequence.
GROUP_PIECES = 8192
# What a worker remembers in all; when it is full, all is forgotten, and frequent words are soon back.
MEMORY_UNITS = 3_000_000
MEMORY_CHARS = 64

# A word and the space before it, and a lone line end between two words, end a pre-token unless white space meets
# white space; texts where that happens are cut at single spaces between other characters only. Python counts more
# characters as white space than the tokenizer does, which only makes fewer cuts.
CUT = re.compile(r"(?<=\S)(?= \S)")
SPACED = re.compile(r" \S+")
# Bytes of letters and white space, and those that end a letter of two bytes after 0xC3: the runs of ``bytelevel.RUN`` in UTF-8.
LETTER, SPACE, ACCENTED = (
    np.array([chosen(chr(b)) for b in range(256)], dtype=bool)
    for chosen in (lambda c: c.isascii() and c.isalpha(), lambda c: c.isascii() and c.isspace(), lambda c: "\x80" <= c <= "\xbf" and c not in "\x97\xb7")
)


# Ranks of no pair, the mark of a free slot, and a factor that spreads pairs over the slots.
NO_RANK = np.iinfo(np.int32).max
NO_PAIR = np.uint64(0xFFFFFFFFFFFFFFFF)
SPREAD = np.uint64(0x9E3779B97F4A7C15)
NOTHING = np.empty(0, dtype=np.uint32)
# Characters of text that are looked up together; a longer text is a batch by itself.
BATCH_CHARS = 1 << 19


class Merges:
    """The merges of a byte-level BPE model, worked out for many words at once.

    In each step every word that has a known pair merges the one of least rank, the first of equals, as the model does for a word
    by itself. Words that are done leave the step's arrays.
    """

    def __init__(self, tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        # Other models leave all words to the tokenizer.
        others = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        vocab = model["vocab"] if model.get("type") == "BPE" and not any(map(model.get, others)) else {}
        # Ids of bytes, and the pairs in open addressing: a slot's pair, rank and merged id.
        self.byte = np.array([vocab.get(c, -1) for c in ALPHABET], dtype=np.int32)
        self.exact = bool((self.byte >= 0).all())
        if not self.exact:
            return
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], dtype=np.uint64) for i in (0, 1))
        made = [vocab[a + b] for a, b in pairs]
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.pair = np.full(1 << bits, NO_PAIR, dtype=np.uint64)
        self.rank = np.full(1 << bits, NO_RANK, dtype=np.int32)
        self.made = np.zeros(1 << bits, dtype=np.int32)
        self.reach = 1
        keys = left << np.uint64(32) | right
        for rank, (key, slot, to) in enumerate(zip(keys.tolist(), self._slots(keys).tolist(), made)):
            tries = 1
            while self.pair[slot] != NO_PAIR and self.pair[slot] != key:
                slot, tries = (slot + 1) & self.mask, tries + 1
            # Of a pair that stands twice the last counts, as in the model's map.
            self.pair[slot], self.rank[slot], self.made[slot] = key, rank, to
            self.reach = max(self.reach, tries)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * SPREAD >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, and what it becomes."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slots(keys)
        rank = np.where(self.pair[slot] == keys, self.rank[slot], np.int32(NO_RANK))
        # Few pairs have been put aside of their slot; a slot that is free ends the search.
        open_ = np.flatnonzero((rank == NO_RANK) & (self.pair[slot] != NO_PAIR))
        for _ in range(1, self.reach):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
            at = slot[open_]
            same = self.pair[at] == keys[open_]
            rank[open_[same]] = self.rank[at[same]]
            open_ = open_[~same & (self.pair[at] != NO_PAIR)]
        return rank, self.made[slot]

    def encode(self, text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and how many each has. ``text`` holds their bytes; no word may be empty."""
        ids = self.byte[text]
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        last = np.append(word[1:] != word[:-1], True)
        rank, to = self._ranks(ids, last, np.arange(len(ids)))
        done_ids, done_words = [NOTHING.astype(np.int32)], [NOTHING.astype(np.int32)]
        while len(ids):
            # The least pair of each word; place decides between equals.
            first = np.flatnonzero(np.append(True, last[:-1]))
            best = np.minimum.reduceat(rank.astype(np.int64) << 32 | np.arange(len(ids)), first)
            more = best < NO_RANK << 32
            best = best[more] & 0xFFFFFFFF
            stay = np.ones(len(ids), dtype=bool)
            if not more.all():
                stay = np.repeat(more, np.diff(np.append(first, len(ids))))
                done_ids.append(ids[~stay])
                done_words.append(word[~stay])
            ids[best] = to[best]
            last[best] = last[best + 1]
            stay[best + 1] = False
            best = (np.cumsum(stay) - 1)[best]
            ids, word, last, rank, to = (x[stay] for x in (ids, word, last, rank, to))
            # Only the pairs of the new token with its neighbours are other than before.
            before = best[best > 0] - 1
            for place in (best, before[~last[before]]):
                rank[place], to[place] = self._ranks(ids, last, place)
        words = np.concatenate(done_words)
        order = np.argsort(words, kind="stable")
        return np.concatenate(done_ids)[order].astype(np.uint32), np.bincount(words, minlength=len(sizes))

    def _ranks(self, ids: np.ndarray, last: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pair that begins at each place, and what it becomes; none begins at the end of a word."""
        rank, to = self.find(ids[place], ids[np.minimum(place + 1, len(ids) - 1)])
        rank[last[place]] = NO_RANK
        return rank, to


class UnitEncoder:
    """Texts -> ids. Words with the space, or the line end, before them are numbered and their ids remembered.

    New words of a batch of texts are worked out together: the leading letters, which are one pre-token, by ``Merges``; the rest goes
    through the whole tokenizer.
    """

    def __init__(self, path: str, memory: int = MEMORY_UNITS):
        from tokenizers import Tokenizer

        self.memory = memory
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = Merges(self.tokenizer)
        self.newline = self.tokens("\n")
        self.forget()

    def forget(self) -> None:
        # Counting goes on without a step in Python for each word.
        self.numbers: defaultdict[str, int] = defaultdict(count().__next__)
        self.flat, self.begin = np.empty(1 << 16, dtype=np.uint32), np.zeros(1 << 14, dtype=np.int64)
        self.size = np.full(1 << 14, -1, dtype=np.int32)
        self.used = 0
        self.rests: dict[bytes, np.ndarray] = {}
        self.held = 0

    def tokens(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def ids(self, text: str) -> bytes:
        return self.tokens(text).astype("<u4").tobytes()

    def rest(self, text: bytes) -> np.ndarray:
        found = self.rests.get(text)
        if found is None:
            found = self.tokens(text.decode())
            if len(text) <= MEMORY_CHARS:
                if len(self.rests) >= self.memory // 4:
                    self.rests.clear()
                self.rests[text] = found
        return found

    def units(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words one after the other, how many each has, and the numbers of the words that white space begins or ends.

        A word counts as if a space stood before it, but for one that a line end begins. No word holds a space.
        """
        data = (" " + " ".join(words) + " ").encode()
        text = np.frombuffer(data, dtype=np.uint8)
        spaces = np.flatnonzero(text == 0x20)
        start, stop = spaces[:-1], spaces[1:]
        line = text[start + 1] == 0x0A
        begin = start + 1 + line
        blank = begin == stop
        odd = blank | SPACE[text[np.minimum(begin, len(text) - 1)]] | SPACE[text[stop - 1]] & ~blank
        # The leading letters, if an ASCII character other than a letter or the end follows.
        letter = LETTER[text]
        pair = (text[:-1] == 0xC3) & ACCENTED[text[1:]]
        letter[:-1] |= pair
        letter[1:] |= pair
        others = np.flatnonzero(~letter)
        run_end = others[np.searchsorted(others, begin)] if len(begin) else begin
        known = (run_end > begin) & (text[run_end] < 0x80) & (stop - begin <= MEMORY_CHARS) & self.merges.exact
        # A character beyond ASCII may be white space.
        for i in np.flatnonzero(~odd & ((text[stop - 1] >= 0x80) & ~letter[stop - 1] | (text[begin] >= 0x80) & ~letter[begin])).tolist():
            own = words[i].removeprefix("\n")
            odd[i] = own[0].isspace() or own[-1].isspace()
        known &= ~odd
        run_start = begin - ~line
        run_end = np.where(known, run_end, run_start)
        some = np.flatnonzero(known)
        many = np.zeros(len(start), dtype=np.int64)
        merged = NOTHING
        if len(some):
            sizes = run_end[some] - run_start[some]
            merged, many[some] = self.merges.encode(text[_places(run_start[some], sizes)], sizes)
        after = np.flatnonzero(~odd & (run_end < stop))
        rests = [self.rest(data[a:b]) for a, b in zip(run_end[after].tolist(), stop[after].tolist())]
        rests, lengths = _joined(rests)
        tail = np.zeros(len(start), dtype=np.int64)
        tail[after] = lengths
        head = np.where(line & ~odd, len(self.newline), 0)
        sizes = head + many + tail
        ends = np.cumsum(sizes)
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint32)
        out[_places(ends - sizes, head)] = np.tile(self.newline, int((head > 0).sum()))
        out[_places(ends - sizes + head, many)] = merged
        out[_places(ends - tail, tail)] = rests
        return out, sizes, np.flatnonzero(odd)

    def learn(self, before: int) -> None:
        """Work out the ids of all keys numbered from ``before`` on. Size -1: white space meets white space there."""
        new = len(self.numbers) - before
        if len(self.size) < before + new:
            room = 2 * (before + new)
            self.begin, self.size = (np.concatenate([x, np.zeros(room - len(x), x.dtype)]) for x in (self.begin, self.size))
        keys = list(islice(reversed(self.numbers), new))[::-1]
        self.held += sum(map(len, keys))
        parts = [i for i, k in enumerate(keys) if k[:1] == " "]
        if parts:
            at = np.array(parts) + before
            self.put(at, *_joined([self.rest(keys[i][1:].encode()) for i in parts]))
            rest = np.delete(np.arange(new), parts)
            keys = [keys[i] for i in rest.tolist()]
        else:
            rest = np.arange(new)
        if keys:
            ids, sizes, odd = self.units(keys)
            self.put(before + rest, ids, sizes)
            self.size[before + rest[odd]] = -1

    def put(self, at: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        if len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(self.used // 2 + 2 * len(ids), dtype=np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.begin[at] = self.used + np.cumsum(sizes) - sizes
        self.size[at] = sizes
        self.used += len(ids)

    def look_up(self, keys: list[list[str]]) -> tuple[np.ndarray, list[int], list[bool]]:
        """The ids of each list of keys, one after the other; where they begin, and whether the list has a key without ids."""
        before = len(self.numbers)
        numbers = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(keys)), dtype=np.int64)
        edges = np.append(0, np.cumsum([len(k) for k in keys]))
        if len(self.numbers) > before:
            self.learn(before)
        sizes = self.size[numbers].astype(np.int64)
        odd = np.logical_or.reduceat(sizes < 0, edges[:-1])
        sizes = np.maximum(sizes, 0)
        ids = self.flat[_places(self.begin[numbers], sizes)]
        return ids, np.append(0, np.cumsum(sizes))[edges].tolist(), odd.tolist()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not texts:
            return []
        # Long words do not stay either.
        if len(self.numbers) >= self.memory or self.held > MEMORY_CHARS * self.memory // 4:
            self.forget()
        # Every text begins as if a line end stood before it, whose ids go again.
        ids, edges, odd = self.look_up([("\n" + t).replace("\n", " \n").split(" ")[1:] for t in texts])
        found = [ids[a + len(self.newline) : b] for a, b in zip(edges, edges[1:])]
        again = [i for i, o in enumerate(odd) if o]
        if again:
            # Parts other than a space and a word are keys with one more space.
            parts = [CUT.split(texts[i]) for i in again]
            ids, edges, _ = self.look_up([[p[1:] if SPACED.fullmatch(p) else " " + p for p in some] for some in parts])
            for i, a, b in zip(again, edges, edges[1:]):
                found[i] = ids[a:b]
        return found

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0].astype("<u4").tobytes()


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([NOTHING, *parts]), np.array([len(x) for x in parts], dtype=np.int64)


def _places(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each, ``many`` of them."""
    ends = np.cumsum(many)
    return np.repeat(begin - (ends - many), many) + np.arange(int(ends[-1]) if len(ends) else 0)


@lru_cache(maxsize=1)
def unit_encoder(path: str, memory: int) -> UnitEncoder:
    """One per Python worker, which keeps its memory from task to task."""
    return UnitEncoder(path, memory)


remembers("packing", unit_encoder.cache_clear)


def _encoded(encoder: UnitEncoder, texts: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each text, worked out for about ``BATCH_CHARS`` at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= BATCH_CHARS:
            yield from encoder.encode_all(held)
            held, size = [], 0
    yield from encoder.encode_all(held)


def tokenize(
    docs: DataFrame, tokenizer: str, end_id: int, length: int, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False, memory: int = MEMORY_UNITS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document longer than ``length`` is cut so that all pieces but the first have that length.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.list_(pa.int32()))] if with_ids else []
    schema = pa.schema(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others("packing")
        encoder = unit_encoder(tokenizer, memory)
        for batch in batches:
            columns = [[] for _ in fields]
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), _encoded(encoder, batch["text"])):
                ids = ids.astype("<u4").tobytes() + end
                total = len(ids) // 4
                first = total % length or min(total, length)
                starts = [0, *range(first, total, length)]
                for piece, start in enumerate(starts):
                    part = ids[4 * start : 4 * (start + (length if piece else first))]
                    row = [doc_id, piece, start, len(part) // 4, zlib.crc32(part)]
                    row += [np.frombuffer(part, dtype="<i4")] if with_ids else []
                    for column, value in zip(columns, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    types = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return source.mapInArrow(cut, types + (", ids array<int>" if with_ids else ""))


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum-of-squares placement in the given order: the sequence and the offset of each length."""
    open_count = np.zeros(capacity + 1, dtype=np.int64)  # sequences by gap; those without a gap are not counted
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    made = 0
    for i, size in enumerate(lengths.tolist()):
        # Moving a sequence from gap g to g - size changes the sum by 2 * (1 + open[g - size] - open[g]), or by
        # 1 - 2 * open[g] if that fills it.
        here = open_count[size:capacity]
        change = 2 * (1 + open_count[: capacity - size] - here)
        if capacity > size:
            change[0] = 1 - 2 * here[0]
        change = np.where(here > 0, change, np.iinfo(np.int64).max)
        best = int(np.argmin(change)) if len(change) else -1
        if best >= 0 and here[best] > 0:
            gap = best + size
            at = stacks[gap].pop()
            open_count[gap] -= 1
        else:
            gap, at = capacity, made
            made += 1
        sequence[i], offset[i] = at, capacity - gap
        if gap > size:
            stacks[gap - size].append(at)
            open_count[gap - size] += 1
    return sequence, offset


def pack(pieces: DataFrame, length: int, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset. ``pieces`` is read twice and so should be a written table.

    The hash of a piece decides its group; order within a group is by length, longest first, then by id.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    dealt = pieces.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("_group"))

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        sequence, offset = place(rows["length"].to_numpy(), length)
        return rows.drop(columns="_group").assign(sequence_id=sequence * groups + int(key[0]), offset=offset)

    types = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return dealt.groupBy("_group").applyInPandas(fill, types)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, length: int, id_col: str = "doc_id", text_col: str = "text",
    group_pieces: int = GROUP_PIECES, memory: int = MEMORY_UNITS,
) -> DataFrame:
    """Tokenize, write the pieces without their ids, and pack them. ``memory`` is how many words a worker remembers."""
    pieces = materialize(tokenize(docs, tokenizer, end_id, length, id_col, text_col, memory=memory), "packing-pieces")
    return pack(pieces, length, group_pieces)


def sequences(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences. ``pieces`` come from ``tokenize(..., with_ids=True)``.

    Repeated pieces hold the same ids, so one of them stands for all.
    """
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    unique = pieces.groupBy(*keys).agg(F.first("ids").alias("ids"))
    same = [placed[k].eqNullSafe(unique[k]) for k in keys]
    joined = placed.join(unique, same).select(placed["sequence_id"], placed["offset"], unique["ids"])
    filled = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return filled.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
