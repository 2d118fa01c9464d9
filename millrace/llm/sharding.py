"""Shards of bounded size by extendible hashing.

A directory is indexed by the first bits of a document's hash. Every entry points to a shard, which has a
local depth: the number of bits that its documents share. A shard above the byte limit splits on its
next bit, and only such shards split, until each fits. The sizes of all prefixes down to the directory's
depth come from one aggregate, combined before it is shuffled; entries that are still too large at that depth are
taken up again with more bits.

The hash covers id and text, so copies of an id with different texts can be parted. Only a document that
is by itself above the limit, or equal rows that are so together, cannot be split: their shard is marked
``oversized``. Null and empty texts have 0 bytes, and a null id counts as an empty one. An empty table
gives no rows. Only id and text are read. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import fits_broadcast
from millrace.session import materialize

BITS = 60
# Directory entries per expected shard, as a power of two, and bits that are added when entries stay too large.
SPARE_BITS = 3
MORE_BITS = 6


def hash_bits(id_col: Column, text_col: Column) -> Column:
    """The first 60 bits of an MD5 hash, as a number."""
    text = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text_col, F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def _prefix(hash_col: str, depth: int) -> Column:
    return F.shiftright(F.col(hash_col), BITS - depth)


def _nodes(fine: DataFrame, base: int, depth: int) -> DataFrame:
    """Bytes, documents and the span of hashes of every prefix between the two depths."""
    each = fine.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(depth))))
    # shiftright takes a fixed distance only, so the parent is reached by division.
    each = each.withColumn("prefix", F.expr(f"entry div shiftleft(1L, {depth} - depth)"))
    return each.groupBy("depth", "prefix").agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def directory(keys: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """(depth, entries) until all documents have a shard: entry, shard depth, prefix, bytes, documents."""
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, max(1, math.ceil(math.log2(max(1, total / limit))) + SPARE_BITS))
    base, levels, rest = 0, [], keys
    while True:
        fine = rest.groupBy(_prefix("hash", depth).alias("entry")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        fine = materialize(fine, "entries")
        nodes = _nodes(fine, base, depth).withColumn(
            "closed", (F.col("shard_bytes") <= limit) | (F.col("low") == F.col("high"))
        )
        nodes = materialize(nodes, "nodes")
        parents = nodes.select((F.col("depth") + 1).alias("d"), F.col("prefix").alias("p"), F.col("closed").alias("above"))
        tops = nodes.where("closed").join(
            parents, (F.col("depth") == F.col("d")) & (F.expr("prefix div 2") == F.col("p")), "left"
        )
        shards = tops.where(~F.coalesce("above", F.lit(False))).select("depth", "prefix", "shard_bytes", "shard_docs")
        pointers = fine.select("entry", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("depth"))
        pointers = pointers.withColumn("prefix", F.expr(f"entry div shiftleft(1L, {depth} - depth)"))
        entries = materialize(pointers.join(shards, ["depth", "prefix"]), "directory")
        levels.append((depth, entries))
        large = nodes.where((F.col("depth") == depth) & ~F.col("closed")).select(F.col("prefix").alias("_p"))
        if large.isEmpty():
            return levels
        rest = materialize(rest.join(large, _prefix("hash", depth) == F.col("_p"), "left_semi"), "large")
        base, depth = depth, min(BITS, depth + MORE_BITS)


def shard(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, shard (its bits as text), depth, shard_bytes, shard_docs, oversized."""
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint")
    keys = docs.select(F.col(id_col).alias("doc_id"), size.alias("bytes"), hash_bits(F.col(id_col), F.col(text_col)).alias("hash"))
    keys = materialize(keys, "keys")
    out = None
    for depth, entries in directory(keys, limit):
        side = F.broadcast(entries) if fits_broadcast(entries) else entries
        found = keys.join(side, _prefix("hash", depth) == F.col("entry")).select(
            "doc_id",
            F.col("bytes").alias("n_bytes"),
            F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))).alias("shard"),
            F.col("depth"),
            "shard_bytes",
            "shard_docs",
            (F.col("shard_bytes") > limit).alias("oversized"),
        )
        out = found if out is None else out.unionByName(found)
    return out


def write_shards(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows of ``docs`` below ``path`` in one folder per shard (``_shard=<bits>``)."""
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc_id"), docs[text_col].alias("text"))
    # The row itself stands for the id: as JSON for the hash, and whole in the result.
    keyed = row.withColumn("_key", F.to_json("doc_id"))
    assigned = shard(keyed.select(F.col("_key").alias("doc_id"), "text"), limit)
    names = assigned.select(F.col("doc_id").alias("_k"), F.col("shard").alias("_shard")).distinct()
    joined = keyed.join(names, keyed["_key"] == names["_k"]).select("doc_id.*", F.concat(F.lit("b"), F.col("_shard")).alias("_shard"))
    joined.repartition(F.col("_shard")).write.partitionBy("_shard").parquet(path)
