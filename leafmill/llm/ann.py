"""Approximate nearest neighbours by a permutation index, for the largest inner product.

A vector is represented by its LENGTH nearest of PIVOTS pivots, in order.  Vectors are first
put on a sphere: divided by the largest norm, with one more component that makes the norm 1, and
queries scaled to norm 1 with a 0 there; then the largest inner product is the smallest distance.
Pivots are the vectors of the smallest hashes, a bounded sample of PIVOTS rows; every row is indexed.

The index is a table of blocks of vectors.  Within a block, vectors are posted in one
inverted file per pivot with their place of it.  For truncated orders the footrule distance
is a constant less twice ``sum(min(LENGTH - place in a, LENGTH - place in b))`` over common pivots, which a
query adds up over the files of its own pivots.  The SHARE of a block that is nearest by footrule
(CANDIDATES at least) is ranked anew by exact inner products in double precision.

Equal vectors are one entry with its smallest ids, as many as a query can need, so copies
neither crowd out candidates nor lose any.  Queries meet blocks of rows in blocks.

Defined results: vectors that are null, zero, or hold null or non-finite components, or whose length is
not the commonest one, take no part, nor do null ids; of rows that repeat an id one stays (the
least vector); ties go to the smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.shared import stage

PIVOTS, LENGTH = 256, 64
SHARE, CANDIDATES = 0.2, 512
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048


@dataclass(frozen=True)
class PermutationIndex:
    """``entries``: block, rep, order (pivot numbers), vector; ``members``: rep, vec_id."""

    entries: DataFrame
    members: DataFrame
    pivots: np.ndarray
    scale: float
    k: int
    blocks: int


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector array<double>): the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    infinite = F.lit(float("inf"))
    rows = rows.where(
        F.col("vec_id").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
        & F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("vector") == (length["n"] if length else 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _orders(vectors: np.ndarray, pivots: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """(n, LENGTH) pivot numbers, nearest first."""
    near = vectors @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1]
    return np.argsort(-near, axis=1, kind="stable")[:, :LENGTH].astype(np.uint8)


def build_index(vectors: DataFrame, k: int = 20) -> PermutationIndex:
    """Index all usable rows of (vec_id, embedding) for searches of up to ``k`` neighbours."""
    spark = vectors.sparkSession
    rows = stage(usable(vectors).withColumn("_same", F.struct(F.xxhash64("vector"), F.xxhash64("vector", F.lit(1)))), "ann-rows")
    fit = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("vector").collect()
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    facts = rows.agg(F.max(norm).alias("scale"), F.count("*").alias("n")).first()
    scale, n = float(facts["scale"] or 1.0), int(facts["n"])
    blocks = max(1, -(-n // BLOCK_ROWS))
    chosen = np.array([r["vector"] for r in fit], np.float64).reshape(len(fit), len(fit[0]["vector"]) if fit else 1)
    pivots = _on_sphere(chosen, scale)

    in_class = Window.partitionBy("_same").orderBy("vec_id")
    members = rows.select("_same", "vec_id").withColumn("_nth", F.row_number().over(in_class)).where(F.col("_nth") <= k + 1)
    least = rows.groupBy("_same").agg(F.min("vec_id").alias("rep"))
    members = stage(members.join(least, "_same").select("rep", "vec_id"), "ann-members")
    shipped = spark.sparkContext.broadcast(pivots)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch.column("vector"), batch.num_rows)
                orders = _orders(own / scale, shipped.value, _lift(own, scale))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block"), batch.column("rep"), pa.array([o.tobytes() for o in orders], pa.binary()), batch.column("vector")],
                    ["block", "rep", "order", "vector"])

    distinct = rows.groupBy("_same").agg(F.min("vec_id").alias("rep"), F.first("vector").alias("vector"))
    entries = distinct.select(F.pmod(F.xxhash64("rep", F.lit(2)), F.lit(blocks)).cast("int").alias("block"), "rep", "vector")
    entries = stage(entries.mapInArrow(index, "block int, rep long, order binary, vector array<double>"), "ann-index")
    return PermutationIndex(entries, members, pivots, scale, k, blocks)


def _lift(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 1.0 - ((vectors / scale) ** 2).sum(1)))


def _on_sphere(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.concatenate((vectors / scale, _lift(vectors, scale)[:, None]), 1)


def _search_block(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "rep": [], "score": []}
        n, m = rows.num_rows, queries.num_rows
        if n and m:
            vectors, asked = _matrix(rows["vector"], n), _matrix(queries["vector"], m)
            reps, ids = rows["rep"].to_numpy(), queries["query_id"].to_numpy()
            orders = np.frombuffer(b"".join(rows["order"].to_pylist()), np.uint8).reshape(n, -1)
            wide = orders.shape[1]
            by_pivot = np.argsort(orders.ravel(), kind="stable")
            posted = (by_pivot // wide).astype(np.int32)
            worth = (wide - by_pivot % wide).astype(np.int16)
            begin = np.searchsorted(orders.ravel()[by_pivot], np.arange(257))
            keep = min(n, max(CANDIDATES, int(SHARE * n)))
            for q, order in enumerate(queries["order"].to_pylist()):
                near = np.zeros(n, np.int16)
                for place, p in enumerate(order):
                    low, high = begin[p], begin[p + 1]
                    near[posted[low:high]] += np.minimum(worth[low:high], wide - place).astype(np.int16)
                chosen = np.argpartition(-near, keep - 1)[:keep] if keep < n else np.arange(n)
                score = (vectors[chosen] * asked[q]).sum(1)
                top = np.lexsort((reps[chosen], -score))[: k + 1]
                out["query_id"].append(np.full(len(top), ids[q]))
                out["rep"].append(reps[chosen[top]])
                out["score"].append(score[top])
        kinds = {"query_id": pa.int64(), "rep": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array(np.concatenate(v) if v else [], kinds[c]) for c, v in out.items()})

    return run


def search(index: PermutationIndex, queries: DataFrame, k: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each usable query (vec_id, embedding) its nearest rows but its own."""
    k = index.k if k is None else min(k, index.k)
    pivots, scale = index.pivots, index.scale

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch.column("vector"), batch.num_rows)
                unit = own / np.sqrt((own ** 2).sum(1))[:, None]
                orders = _orders(unit, pivots, np.zeros(len(own)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id"), pa.array([o.tobytes() for o in orders], pa.binary()), batch.column("vector")],
                    ["query_id", "order", "vector"])

    asked = usable(queries).withColumnRenamed("vec_id", "query_id")
    asked = stage(asked.mapInArrow(order, "query_id long, order binary, vector array<double>"), "ann-queries")
    parts = max(1, -(-asked.count() // BLOCK_QUERIES))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id", F.lit(3)), F.lit(parts)).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(index.blocks - 1))))
    rows = index.entries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = rows.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(
        _search_block(k), "query_id long, rep long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    classes = found.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= k + 1)
    each = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        classes.join(index.members, "rep").where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
