"""Mixing sources to target weights, block by block.

The words of each source, document after document, are cut into blocks of fixed length. Output shards
have a fixed number of slots. For every shard the number of slots of each source is drawn from the
multinomial distribution of the target weights; draws beyond what a source owes in total go to the
sources that fall short, so the whole mix meets its targets. The j-th slot of a source takes the block
that a pseudorandom permutation of the source's block numbers assigns to j; when all blocks have been
taken the permutation starts over. Blocks join slots by (source, block).

All numbers come from hashes of (seed, source rank, position), so reruns agree. Only built-in functions are used.
Streams are laid out in lanes: documents are dealt over lanes by hash, positions are summed up within a
lane and lanes are summed up per source, so a source with a third of all rows is no single sort.

Sources are one small row each and are ranked in one task, so they should be some thousands, not one per host. Null is a source of
its own, ranked last. Null and empty texts have size 0 and are never taken; long ones count whole. Repeated rows are separate
documents: positions break ties in any order, as equal rows are interchangeable. An empty table gives no rows. Other columns are
carried in a struct of their own and cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.words import word_count
from millrace.session import materialize

# Documents in a lane: what one task sorts.
LANE_DOCS = 1024
# Cells of the line of cumulated targets, to find the source under a drawn point by equality.
CELLS = 4096
ROUNDS = 24
SPAN = 1 << 62


@dataclass(frozen=True)
class Mix:
    """Weights by rank of the source, repeated in turn; sizes in words."""

    weights: tuple[float, ...] = (3, 1, 2)
    total: float = 1.5
    most: float = 2.0
    block: int = 128
    shard_slots: int = 4096
    seed: int = 7


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """rank, source, source_size, target of each source, from its size.

    Without caps each target is its weight's share of the total. The sources that reach ``most`` times
    their size first are those with the least size per weight; the level at which the others stand
    follows from cumulated sums in that order.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]), (F.col("rank") % len(mix.weights) + 1).cast("int"))
    df = sizes.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", weight)
    df = df.withColumn("cap", F.col("source_size") * mix.most)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    df = df.withColumn("want", F.least(mix.total * F.sum("source_size").over(everything), F.sum("cap").over(everything)))
    rest = F.col("want") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    # The level if this source and all later ones share the rest by weight; the first that stays below its cap sets it.
    df = df.withColumn("_level", rest / F.sum("weight").over(after))
    free = F.col("_level") * F.col("weight") < F.col("cap")
    df = df.withColumn("_free", F.max(free.cast("int")).over(fill) > 0)
    df = df.withColumn("_at", F.first(F.when(free, F.col("_level")), ignorenulls=True).over(fill))
    target = F.when(F.col("_free"), F.least(F.col("_at") * F.col("weight"), F.col("cap"))).otherwise(F.col("cap"))
    return df.select("rank", "source", "source_size", target.alias("target"))


def _mixed(seed: int, *values: Column) -> Column:
    """A hash below 2^62."""
    return F.xxhash64(F.lit(seed), *values).bitwiseAND(F.lit(SPAN - 1))


def permuted(index: Column, size: Column, seed: int, key: Column) -> Column:
    """A pseudorandom permutation of 0 .. size - 1 for each key, evaluated at ``index``.

    In each round an index and its mirror image around a random point change places or not, by a coin
    that both share; so every round, and all of them together, is a permutation for any size.
    """

    def turn(x: Column, r: Column) -> Column:
        mirror = F.pmod(_mixed(seed, key, r) % size - x, size)
        coin = _mixed(seed + 1, key, r, F.greatest(x, mirror)).bitwiseAND(F.lit(1))
        return F.when(coin == 1, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), index.cast("bigint"), turn)


def layout(docs: DataFrame, mix: Mix, id_col: str, text_col: str, source_col: str, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents with the rank of their source and their first position in its stream; the sources.

    ``row_col`` names a column that rides along as ``row``.
    """
    extra = [F.col(row_col).alias("row")] if row_col else []
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(mix.seed), F.col(id_col), F.col(text_col)).alias("_h"),
        *extra,
    )
    sized = materialize(sized, "sized")
    lanes = max(1, -(-sized.count() // LANE_DOCS))
    sized = sized.withColumn("_lane", F.pmod("_h", F.lit(lanes)))
    per_lane = materialize(sized.groupBy("source", "_lane").agg(F.sum("size").alias("lane_size")), "lanes")
    sources = materialize(
        source_targets(per_lane.groupBy("source").agg(F.sum("lane_size").alias("source_size")), mix), "sources"
    )
    ahead = Window.partitionBy("source").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    per_lane = per_lane.withColumn("_lane_start", F.coalesce(F.sum("lane_size").over(ahead), F.lit(0)))
    lane = per_lane.join(sources, per_lane["source"].eqNullSafe(sources["source"])).select(
        "rank", per_lane["source"].alias("_source"), F.col("_lane").alias("_l"), "_lane_start", "source_size", "target"
    )
    within = Window.partitionBy("source", "_lane").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(lane, placed["source"].eqNullSafe(lane["_source"]) & (placed["_lane"] == lane["_l"]))
    start = F.col("_lane_start") + F.col("_before")
    keep = ["doc_id", "source", "size", "rank", "source_size", "target"] + (["row"] if row_col else [])
    return placed.select(*keep, start.alias("start"), "_lane", "_before", "_h"), sources


def quotas(sources: DataFrame, mix: Mix) -> DataFrame:
    """rank, blocks, slots: how many slots each source owes, whole rounds over its blocks and a rest."""
    size, blocks = F.col("source_size"), F.ceil(F.col("source_size") / mix.block).cast("bigint")
    rounds = F.floor(F.col("target") / size).cast("bigint")
    rest = F.round((F.col("target") - rounds * size) / (size / blocks)).cast("bigint")
    return (
        sources.where(size > 0)
        .withColumn("blocks", blocks)
        .withColumn("slots", rounds * blocks + F.least(rest, blocks))
        .select("rank", "blocks", "slots", "target")
    )


def mixture(sources: DataFrame, mix: Mix) -> DataFrame:
    """shard, slot, rank, block: which block of which source stands in each slot of each output shard."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    quota = quotas(sources, mix)
    line = materialize(
        quota.withColumn("_all", F.sum("slots").over(everything))
        .withColumn("_low", F.coalesce(F.sum("slots").over(upto), F.lit(0)) / F.col("_all"))
        .withColumn("_high", F.sum("slots").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)) / F.col("_all")),
        "line",
    )
    total = line.agg(F.max("_all")).first()[0] or 0
    cells = line.where("slots > 0").select(
        "rank", "_low", "_high",
        F.explode(F.sequence(F.floor(F.col("_low") * CELLS), F.least(F.floor(F.col("_high") * CELLS), F.lit(CELLS - 1)))).alias("_cell"),
    )
    # The multinomial draw: every slot of every shard falls on a point of the line of cumulated weights.
    slots = docs_range(sources, total).select(
        F.expr(f"id div {mix.shard_slots}").alias("shard"), (F.col("id") % mix.shard_slots).alias("slot")
    )
    slots = slots.withColumn("_point", _mixed(mix.seed + 2, F.col("shard"), F.col("slot")) / F.lit(float(SPAN)))
    drawn = slots.withColumn("_cell", F.floor(F.col("_point") * CELLS)).join(cells, "_cell")
    drawn = drawn.where((F.col("_point") >= F.col("_low")) & (F.col("_point") < F.col("_high"))).select("shard", "slot", "rank")
    drawn = materialize(drawn, "drawn")

    counts = drawn.groupBy("rank", "shard").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumnsRenamed(
        {"rank": "_r", "shard": "_s"}
    )
    turn = Window.partitionBy("rank", "shard").orderBy("slot")
    numbered = drawn.withColumn("_k", F.row_number().over(turn) - 1)
    numbered = numbered.join(counts, (F.col("rank") == F.col("_r")) & (F.col("shard") == F.col("_s"))).select(
        "shard", "slot", "rank", (F.col("_first") + F.col("_k")).alias("j")
    )
    # Draws beyond a quota, in order, fill the numbers that other sources still owe, in order.
    seen = drawn.groupBy("rank").agg(F.count(F.lit(1)).alias("_got"))
    even = (
        line.join(seen, "rank", "left")
        .withColumn("_got", F.coalesce("_got", F.lit(0)))
        .withColumn("_over", F.greatest(F.col("_got") - F.col("slots"), F.lit(0)))
        .withColumn("_under", F.greatest(F.col("slots") - F.col("_got"), F.lit(0)))
        .withColumn("_over_first", F.coalesce(F.sum("_over").over(upto), F.lit(0)))
        .withColumn("_under_first", F.coalesce(F.sum("_under").over(upto), F.lit(0)))
    )
    even = materialize(even.select("rank", "blocks", "slots", "_got", "_under", "_over_first", "_under_first"), "even")
    numbered = numbered.join(even, "rank")
    kept = numbered.where(F.col("j") < F.col("slots")).select("shard", "slot", "rank", "j", "blocks")
    spare = numbered.where(F.col("j") >= F.col("slots")).select(
        "shard", "slot", (F.col("_over_first") + F.col("j") - F.col("slots")).alias("_n")
    )
    owed = even.where("_under > 0").select(
        "rank", "blocks", "_got", "_under_first", F.explode(F.sequence(F.lit(0), F.col("_under") - 1)).alias("_m")
    )
    owed = owed.select("rank", "blocks", (F.col("_got") + F.col("_m")).alias("j"), (F.col("_under_first") + F.col("_m")).alias("_n"))
    moved = spare.join(owed, "_n").select("shard", "slot", "rank", "j", "blocks")
    block = permuted(F.col("j") % F.col("blocks"), F.col("blocks"), mix.seed + 3, F.col("rank"))
    return kept.unionByName(moved).select("shard", "slot", "rank", "j", block.alias("block"))


def docs_range(like: DataFrame, n: int) -> DataFrame:
    return like.sparkSession.range(n)


def spans(placed: DataFrame, mix: Mix) -> DataFrame:
    """One row per document and block that it reaches into: block, and the words [low, high) of the document there."""
    size, start = F.col("size"), F.col("start")
    last = F.expr(f"(start + size - 1) div {mix.block}")
    df = placed.where(size > 0).withColumn("block", F.explode(F.sequence(F.expr(f"start div {mix.block}"), last)))
    low = F.greatest(F.col("block") * mix.block - start, F.lit(0))
    high = F.least((F.col("block") + 1) * mix.block - start, size)
    return df.withColumn("low", low).withColumn("high", high)


def block_uses(plan: DataFrame) -> DataFrame:
    return plan.groupBy("rank", "block").agg(F.count(F.lit(1)).alias("uses"))


def taken(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken: how many words of each document the mix takes, repeats counted."""
    placed, sources = layout(docs, mix, id_col, text_col, source_col)
    placed = materialize(placed, "placed")
    used = block_uses(mixture(sources, mix))
    key = ["doc_id", "size", "source_size", "target"]
    parts = spans(placed, mix).join(used, ["rank", "block"], "left")
    words = F.coalesce(F.col("uses"), F.lit(0)) * (F.col("high") - F.col("low"))
    whole = parts.groupBy(*key, "rank", "start").agg(F.sum(words).alias("taken")).select(*key, "taken")
    none = placed.where(F.col("size") == 0).select(*key, F.lit(0).cast("bigint").alias("taken"))
    return whole.unionByName(none)


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents: for each use of a document's blocks a row with the words that are taken.

    A document whose blocks are all taken once stays as it is; one that is taken twice comes twice. Words
    keep the white space after them. The other columns of ``docs`` are kept as they are.
    """
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    # Only numbers go through the sorting; the rows themselves wait in a table and are joined once.
    rows = materialize(docs.select(row, F.monotonically_increasing_id().alias("number")), "rows")
    field = F.col("row").getField
    slim = rows.select(field(id_col).alias("id"), field(text_col).alias("text"), field(source_col).alias("source"), "number")
    placed, sources = layout(slim, mix, "id", "text", "source", "number")
    placed = materialize(placed, "placed")
    used = block_uses(mixture(sources, mix))
    parts = spans(placed, mix).join(used, ["rank", "block"]).where("low < high")
    use = parts.withColumn("use", F.explode(F.sequence(F.lit(1), F.col("uses"))))
    cuts = use.groupBy(F.col("row").alias("number"), "size", "use").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("cuts"))
    full = rows.join(cuts, "number")
    text = field(text_col)
    whole = F.aggregate("cuts", F.lit(0).cast("bigint"), lambda n, c: n + c["high"] - c["low"]) == F.col("size")
    # Each word with the white space after it. Made once per row, so it is needed in two places.
    full = full.withColumn("_pieces", F.when(~whole, F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))))
    part = F.transform("cuts", lambda c: F.slice("_pieces", (c["low"] + 1).cast("int"), (c["high"] - c["low"]).cast("int")))
    full = full.withColumn("_text", F.when(F.col("_pieces").isNull(), text).otherwise(F.array_join(F.flatten(part), "")))
    return full.select(*[F.col("_text").alias(c) if c == text_col else field(c).alias(c) for c in docs.columns])
