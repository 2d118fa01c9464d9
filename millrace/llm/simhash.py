"""Near duplicates by SimHash, found with hierarchical indexes in Gray order.

A fingerprint has a bit set if over half of the hashes of the text's word shingles have it set. Equal
fingerprints are one node with its smallest document id, so groups of copies, however large, shrink to
one row before anything is compared. Two fingerprints that differ in at most ``bits`` bits agree on at least
one of ``bits + 1`` blocks of bits: nodes are dealt by (block, value) over buckets. A block value with too
many nodes is divided again by blocks of the other bits, which keeps every pair together once more. In a
bucket, fingerprints are sorted by Gray rank, so those that share leading bit patterns stand together; the shared
patterns are the upper nodes of a tree, eight bits a level. The tree is joined with itself from the root:
differences add up level by level, and two groups part as soon as they exceed ``bits``.

Every bucket hands on a spanning set of its links instead of all pairs, and the components follow from
alternating star operations on a written table. No list of documents or links reaches the driver.

Null, empty and blank texts have fingerprint zero, which links like any other. Texts shorter than a
shingle are one shingle, long texts are hashed whole. Repeated rows and ties share a fingerprint and so a component. A null id belongs to its
component but never names it; a component without any id has a null name. An empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

SEED = 42
# Fingerprints in a bucket, and with one block value.
BUCKET_NODES = 4096
GROUP_NODES = 50_000
LEVEL_BITS = 8
CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The fingerprint of UTF-8 text as an unsigned number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    k = min(shingle, len(words))
    starts, ends = (ends - sizes)[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for low in range(0, len(starts), CHUNK):
        part = zip(starts[low : low + CHUNK], ends[low : low + CHUNK])
        hashes = np.array([digest(line[a:b], SEED) for a, b in part], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, h: the row's id and its fingerprint as a signed number."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select(F.col(id_col).alias("id"), of(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("h"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def close_pairs(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct codes and the index pairs (i < j) that differ in at most ``bits`` bits."""
    codes = np.unique(codes)
    codes = codes[np.argsort(gray_rank(codes))]
    left = right = np.zeros(1, dtype=np.int64)  # pairs of tree nodes, the root with itself at first
    total = np.zeros(1, dtype=np.int64)
    first = np.array([0, len(codes)])  # where the nodes of the level above begin, and the end
    for level in range(64 // LEVEL_BITS):
        shift = np.uint64(64 - LEVEL_BITS * (level + 1))
        prefix = codes >> shift
        begins = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
        pattern = (prefix[begins] & np.uint64((1 << LEVEL_BITS) - 1)).astype(np.uint8)
        # Children of each node above: a range of this level's nodes.
        low = np.searchsorted(begins, first[:-1])
        many = np.diff(np.append(low, len(begins)))
        a, b = many[left], many[right]
        size = a * b
        pair = np.repeat(np.arange(len(left)), size)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        x, y = low[left[pair]] + nth // b[pair], low[right[pair]] + nth % b[pair]
        differ = total[pair] + np.bitwise_count(pattern[x] ^ pattern[y])
        keep = (differ <= bits) & (x <= y)
        left, right, total = x[keep], y[keep], differ[keep]
        first = np.append(begins, len(codes))
    apart = left != right
    return codes, left[apart], right[apart]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _divided(mask: int, parts: int) -> list[int]:
    """The mask with one of ``parts`` runs of its open bits added to it."""
    free = [i for i in range(64) if not mask >> i & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _dealt(nodes: DataFrame, bits: int, most: int) -> DataFrame:
    """h, mask: each node under every block that it may share with a node at most ``bits`` bits away."""
    masks = _divided(0, bits + 1)
    rows = nodes.select("h", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    value = F.col("h").bitwiseAND(F.col("mask"))
    done = None
    while True:
        rows = materialize(rows.withColumn("value", value), "blocks")
        large = rows.groupBy("mask", "value").count().where(F.col("count") > most).select("mask", "value")
        # A mask that leaves few bits open cannot have many nodes, so this ends.
        if min(64 - m.bit_count() for m in masks) <= bits + 1 or large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        large = materialize(large, "large")
        few = rows.join(large, ["mask", "value"], "left_anti")
        done = few if done is None else done.unionByName(few)
        more = {m: _divided(m, bits + 1) for m in masks}
        choice = F.create_map(*[c for m, ms in more.items() for c in (F.lit(_signed(m)), F.array(*[F.lit(_signed(x)) for x in ms]))])
        rows = rows.join(large, ["mask", "value"], "left_semi").select("h", F.explode(choice[F.col("mask")]).alias("mask"))
        masks = sorted({x for ms in more.values() for x in ms})


def links(nodes: DataFrame, bits: int, bucket_nodes: int = BUCKET_NODES, group_nodes: int = GROUP_NODES) -> DataFrame:
    """u, v: links between fingerprints at most ``bits`` bits apart that span all their components."""
    dealt = _dealt(nodes, bits, group_nodes)
    buckets = max(1, -(-dealt.count() // bucket_nodes))
    dealt = dealt.select("h", F.pmod(F.xxhash64("mask", "value"), F.lit(buckets)).alias("bucket"))
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def spanning(table: pa.Table) -> pa.Table:
        codes, a, b = close_pairs(table["h"].to_numpy().view(np.uint64), bits)
        root = _roots(len(codes), a, b)
        inner = np.flatnonzero(root != np.arange(len(codes)))
        codes = codes.view(np.int64)
        return pa.table([codes[inner], codes[root[inner]]], schema=schema)

    return dealt.groupBy("bucket").applyInArrow(spanning, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """u, root: the smallest node that each linked node reaches, itself left out if it is the root.

    Each round first points all larger neighbours of a node to its smallest one, then all smaller ones, until
    the edges stay the same. Hot nodes are combined before they are shuffled, and joins split them.
    """
    big, small = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = materialize(edges.select(big, small).where("u <> v").distinct(), "links")

    def seen(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    mark = seen(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", "m")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = materialize(small.where("u <> v").distinct(), "small-star")
        now = seen(edges)
        if now == mark:
            return edges.select("u", F.col("v").alias("root"))
        mark = now


def hex_text(h: Column) -> Column:
    return F.lower(F.lpad(F.hex(h), 16, "0"))


def near_groups(
    docs: DataFrame, shingle: int = 3, bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
    bucket_nodes: int = BUCKET_NODES, group_nodes: int = GROUP_NODES,
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest id in reach)."""
    marked = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = materialize(marked.groupBy("h").agg(F.min("id").alias("least")), "nodes")
    roots = components(links(nodes, bits, bucket_nodes, group_nodes))
    named = nodes.join(roots, F.col("h") == F.col("u"), "left").select("h", "least", F.coalesce("root", "h").alias("root"))
    named = materialize(named, "roots")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
    # Most nodes are alone and need no second look.
    groups = names.where("nodes > 1").select(F.col("root").alias("r"), "component_id")
    named = named.join(groups, F.col("root") == F.col("r"), "left")
    named = named.select(F.col("h").alias("node"), F.coalesce("component_id", "least").alias("component_id"))
    joined = marked.join(named, F.col("h") == F.col("node"))
    return joined.select(F.col("id").alias("doc_id"), hex_text(F.col("h")).alias("fingerprint"), "component_id")


def representatives(
    docs: DataFrame, shingle: int = 3, bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, of equal ids the smallest text hash.

    Rows of a component without any id are judged by their text hash alone.
    """
    keyed = docs.select(F.struct(id_col, F.xxhash64(text_col).alias("t")).alias("key"), F.col(text_col).alias("text"))
    groups = near_groups(keyed, shingle, bits, "key", "text")
    # Structs compare field by field, so a component's name is the key of its first row.
    chosen = materialize(groups.select("component_id").distinct(), "chosen")
    chosen = chosen.select(F.col(f"component_id.{id_col}").alias("_id"), F.col("component_id.t").alias("_text"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("t"))
    kept = rows.join(chosen, rows["id"].eqNullSafe(chosen["_id"]) & (rows["t"] == chosen["_text"]), "left_semi")
    kept = kept.dropDuplicates(["id", "t"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
