"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Sizes are words.  Each source's documents are shuffled by a hash and laid end to end; the stream
is cut into blocks of equal length and may be read more than once.  A source's target gives its
number of slots.  The slots of all sources lie side by side on a lattice of ``2**m`` points, the
cumulative weights, and a slot's place in the mix is its van der Corput point: the point's bits
reversed.  So every stretch of the mix holds the sources close to their weights.  Slots are
ranked per source by place, and the k-th takes the k-th block of the stream, round and round.

Defined results: null and empty texts have size 0 and are never taken; a null source is a source
of its own, weighed last; a source of size 0 has target 0; an empty table gives no rows; repeated
rows are rows of their own.  Other columns of the input do not matter and are not kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.shared import running_start, stage, word_count

WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 128
ROWS_PER_BUCKET = 20_000
PLACES_PER_CHUNK_BITS = 16


@dataclass(frozen=True)
class Mix:
    """``targets`` per source; ``slots`` of the mix (source, place, block, epoch, words);
    ``taken`` per row: doc_id, size, source, source_size, target, taken."""

    targets: DataFrame
    slots: DataFrame
    taken: DataFrame


def source_key(source: Column) -> Column:
    """A key that is never null and sorts by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0,
                   weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Words each source (key, source_size) gives to the mix.

    Weights repeat in the order of the keys.  A target stops at ``most`` times the source's size,
    and the excess is shared anew by weight.  Sources full below the final level are those of the
    smallest room per weight, so one pass in that order finds the level.  The windows run over
    sources, not over documents.
    """
    by_key, by_room = Window.orderBy("key"), Window.orderBy("_room", "key")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("_rank", F.row_number().over(by_key) - 1)
        .withColumn("weight", weight.cast("double"))
        .withColumn("_cap", F.col("source_size") * F.lit(most))
        .withColumn("_room", F.col("_cap") / F.col("weight"))
        .withColumn("_all", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                    / F.sum("weight").over(after))
        .withColumn("_level", F.max(F.when(F.col("_room") > F.col("_level"), F.col("_level"))).over(everything))
        .withColumn("target", F.coalesce(F.least("_cap", F.col("_level") * F.col("weight")), F.col("_cap")))
        .select("key", "source_size", "weight", "target")
    )


def _reversed_bits(x: Column) -> Column:
    for shift, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F),
                        (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        m = F.lit(mask)
        x = F.shiftrightunsigned(x, shift).bitwiseAND(m).bitwiseOR(F.shiftleft(x.bitwiseAND(m), shift))
    return F.shiftrightunsigned(x, 32).bitwiseOR(F.shiftleft(x, 32))


def slot_schedule(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(key, place, block, epoch, words): one row per slot, ``words`` taken from its block's start.

    A block is full but for a stream's last one; the last slot of a source stops at its target.
    """
    wanted, size = F.round("target").cast("long"), F.col("source_size")
    by_key = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    quotas = (
        targets.where("source_size > 0")
        .withColumn("n_blocks", F.ceil(size / block).cast("long"))
        .withColumn("full", F.floor(wanted / size).cast("long")).withColumn("rest", wanted % size)
        .withColumn("slots", F.col("full") * F.col("n_blocks") + F.ceil(F.col("rest") / block).cast("long"))
        .withColumn("from_point", F.coalesce(F.sum("slots").over(by_key), F.lit(0)))
        .withColumn("bits", F.length(F.bin(F.sum("slots").over(everything))).cast("int"))
        .where("slots > 0")
    )
    chunk = 1 << PLACES_PER_CHUNK_BITS
    points = (
        quotas.withColumn("_low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(chunk).cast("long"))))
        .repartition(targets.sparkSession.sparkContext.defaultParallelism, "key", "_low")
        .withColumn("_at", F.explode(F.sequence(F.col("_low"), F.least(F.col("_low") + chunk, F.col("slots")) - 1)))
        .withColumn("place", F.call_function(
            "shiftrightunsigned", _reversed_bits(F.col("from_point") + F.col("_at")), F.lit(64) - F.col("bits")))
        .withColumn("_chunk", F.shiftrightunsigned("place", PLACES_PER_CHUNK_BITS))
        .withColumn("_one", F.lit(1).cast("long"))
    )
    in_chunk = Window.partitionBy("key", "_chunk").orderBy("place")
    ranked = (
        points.hint("merge").join(running_start(points, ["key"], "_chunk", "_one"), ["key", "_chunk"])
        .withColumn("rank", F.col("_start") + F.row_number().over(in_chunk) - 1)
    )
    number, long_block = F.col("rank") % F.col("n_blocks"), F.lit(block).cast("long")
    length = F.least(long_block, F.col("source_size") - number * block)
    last = F.col("rank") == F.col("slots") - 1
    return ranked.select(
        "key", "place", number.alias("block"), F.floor(F.col("rank") / F.col("n_blocks")).cast("long").alias("epoch"),
        F.when(last & (F.col("rest") > 0), F.col("rest") - number * block).otherwise(length).alias("words"),
    )


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS,
        block: int = BLOCK_WORDS, seed: int = 7) -> Mix:
    """The mix of ``docs`` (doc_id, text, source); see the module for the method and its edge cases."""
    rows = stage(docs.select(
        "doc_id", "source", source_key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"),
    ).withColumn("_hash", F.xxhash64("doc_id", "size", F.lit(seed))), "mix-rows")
    sizes = stage(rows.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "mix-sizes")
    targets = stage(source_targets(sizes.drop("n"), share, most, weights), "mix-targets")
    n_rows = sizes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, n_rows // ROWS_PER_BUCKET)

    dealt = rows.where("size > 0").withColumn("_bucket", F.pmod(F.shiftright("_hash", 20), F.lit(buckets)))
    up_to = (Window.partitionBy("key", "_bucket").orderBy("_hash", "doc_id", "size")
             .rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        dealt.withColumn("_inner", F.coalesce(F.sum("size").over(up_to), F.lit(0)))
        .join(running_start(dealt, ["key"], "_bucket", "size"), ["key", "_bucket"])
        .withColumn("at", F.col("_start") + F.col("_inner"))
    )
    number = F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)))
    # sizes of exploded rows are not known to the planner, so no side of these joins may be sent whole
    pieces = placed.select("key", "doc_id", "size", "at", number.alias("block"))
    slots = slot_schedule(targets, block)
    begin = F.greatest(F.col("at"), F.col("block") * block)
    end = F.least(F.col("at") + F.col("size"), F.col("block") * block + F.col("words"))
    taken = (
        pieces.hint("merge").join(slots.select("key", "block", "words"), ["key", "block"], "left")
        .groupBy("key", "at", "doc_id", "size")
        .agg(F.sum(F.when(F.col("words").isNull(), 0).otherwise(F.greatest(end - begin, F.lit(0)))).alias("taken"))
        .select("key", "doc_id", "size", "taken")
        .union(rows.where("size = 0").select("key", "doc_id", "size", F.lit(0).cast("long")))
    )
    return Mix(targets, slots, taken.join(targets, "key").select(
        "doc_id", "size", F.when(F.col("key") != "1", F.substring("key", 2, 1 << 30)).alias("source"),
        "source_size", "target", "taken"))
