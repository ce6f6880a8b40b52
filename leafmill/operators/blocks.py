"""Postings in blocks: a search reads of its frequent terms what its rarest one asks for.

A block holds up to BLOCK row keys of one token, next to each other by hash, and the least and greatest hash.  A frequent
token has many blocks, and no list of its rows exists anywhere.  A search takes the rows of the rarest term, finds by
the blocks' ends which blocks of the next term can hold any of them, and opens those only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.operators.ids import with_row_id
from leafmill.operators.search import FORWARD, query_terms
from leafmill.session import settle

BLOCK = 4096
ROW_GROUP_BYTES = 1 << 20


def _keys(key: str | list[str] | tuple[str, ...]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def posting_blocks(posted: DataFrame, key: str | list[str] | tuple[str, ...], block: int = BLOCK) -> DataFrame:
    """``(token, block, n, low, high, entries)`` of the forward side of ``operators.search.postings``.

    Blocks are cut by position in one sort by token, hash and key, and at the ends of tokens.
    """
    keys = _keys(key)
    entries = (posted.filter(F.col("side") == FORWARD).select("token", *keys).distinct()
               .withColumn("_place", F.xxhash64(*keys)))
    numbered = with_row_id(entries, "token", "_place", *keys, name="_id")
    return numbered.groupBy("token", F.expr(f"(_id - 1) DIV {block}").alias("block")).agg(
        F.count("*").alias("n"), F.min("_place").alias("low"), F.max("_place").alias("high"),
        F.collect_list(F.struct(*keys)).alias("entries"))


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Token and block order on disk in small row groups, so that statistics find single blocks."""
    ranged = blocks.repartitionByRange("token", "block").sortWithinPartitions("token", "block")
    (ranged.write.mode("overwrite").option("parquet.block.size", str(ROW_GROUP_BYTES))
     .option("parquet.bloom.filter.enabled#token", "true").parquet(path))


def _cell(place: Column, bits: int) -> Column:
    """One of 2**bits equal ranges of hashes."""
    return F.shiftright(place, 64 - bits) if bits else F.lit(0).cast("bigint")


def blocks_asked(heads: DataFrame, rows: DataFrame, key: str | list[str] | tuple[str, ...], n_blocks: int) -> DataFrame:
    """``block`` of those ``heads`` (block, low, high; of one token) whose range holds a key of ``rows``.

    Both sides meet in as many equal ranges of the hash as there are blocks, so a range has about one block.
    """
    bits = max(0, (n_blocks - 1).bit_length())
    spans = heads.select("block", "low", "high", F.explode(
        F.sequence(_cell(F.col("low"), bits), _cell(F.col("high"), bits))).alias("cell"))
    place = F.xxhash64(*_keys(key))
    asked = rows.select(place.alias("place"), _cell(place, bits).alias("cell"))
    return spans.join(asked, "cell").where("place BETWEEN low AND high").select("block").distinct()


def block_lookup(blocks: DataFrame, query: str, key: str | list[str] | tuple[str, ...]) -> DataFrame:
    """Row keys holding every term, rarest term first.  A query without terms finds nothing."""
    keys, terms = _keys(key), query_terms(query)
    mine = blocks.where(F.col("token").isin(terms))
    counts = {r["token"]: (r["n"], r["blocks"]) for r in mine.groupBy("token").agg(
        F.sum("n").alias("n"), F.count("*").alias("blocks")).collect()}
    if not terms or len(counts) < len(terms):
        return _entries(blocks.where(F.lit(False)), keys)
    found = None
    for term in sorted(terms, key=lambda t: (counts[t], t)):
        own = blocks.where(F.col("token") == term)
        if found is None:
            found = _entries(own, keys)
            continue
        found = settle(found, "found")
        asked = blocks_asked(own, found, keys, counts[term][1])
        found = _entries(own.join(asked, "block", "left_semi"), keys).join(found, keys, "left_semi")
    return found


def _entries(blocks: DataFrame, keys: list[str]) -> DataFrame:
    return blocks.select(F.explode("entries").alias("_e")).select(*[F.col(f"_e.{c}").alias(c) for c in keys])
