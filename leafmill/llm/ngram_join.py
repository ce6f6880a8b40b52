"""Similarity join of documents on five-word shingles with filters under two global orders.

Two documents link when ``100 * |A n B| >= percent * |A u B|`` for their shingle sets A and B.

*Nodes.*  Documents with equal sets are one node, named by a 64-bit hash of the sorted set.

*Orders.*  For similar sets, the first ``n - ceil(percent/100 * n) + 1`` shingles of both share
one under any global order of shingles.  Order one is by frequency, rare first: frequencies come from
a table of ``2**SKETCH_BITS`` counters over all documents, whose size does not depend on the data
(a task's counter stops at 255); an order may be any, so a coarse count costs time, never a link.  Order two is by
hash; its prefix is ``EXTRA`` shingles longer, and similar sets share ``EXTRA + 1`` of it (or all that
a shorter set requires).  A pair must pass both before its sets are compared in full.

*Bounds.*  Up to the end of whichever of two first prefixes ends earlier in the order, both prefixes are
complete, so that a shingle posted there by no other node is not common.  The node of that
prefix can share no more than the rest, which must reach what a link needs.  Two texts that only
have a passage in common fail this at once, and so do the far members of a group of near copies.

*Pairs.*  Shingles of first prefixes that two nodes share are kept, with their nodes; of shingles with
the same nodes one is kept.  In each of ``STARS`` rounds every shingle proposes one centre against its other
nodes of another component, which is one pair per posting: first the node with the fewest
shingles of its own, later a random one.  Verified links join components.  After these rounds each
shingle proposes the pairs across components that were not tried, of the same or neighbouring classes of size, and
only if the bounds allow it and enough of the prefix that ends earlier is common from this shingle on; at the first
shared shingle that is all they have in common.
Within a component no pair needs to be tried, so a group of many near copies stays linear.

Defined results: a null, empty or blank text has an empty set and no links; texts of fewer than five
words have one shingle, the whole; repeated rows with one doc_id give one row for each row; a null
doc_id takes part in no link and is its own component (null); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.shared import components, stage
from leafmill.llm.words import mix, shingles, slices, words

WORDS, PERCENT = 5, 80
SKETCH_BITS, SKETCH_PARTS = 22, 256
MARK_BITS = 26
SLICE = 1 << 20  # bytes of text a worker hashes at a time; arrays on the way are some twenty times that
EXTRA = 32
STARS = 2
_U = np.uint64


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of a slice's texts that have words."""
    value, bounds = shingles(*words(batch.column("text")), n)
    for row in np.flatnonzero(np.diff(bounds)):
        yield int(row), np.unique(value[bounds[row]: bounds[row + 1]])


def _node(own: np.ndarray) -> np.ndarray:
    """A 64-bit name of a sorted set; -1 is kept for no set."""
    at = np.arange(1, len(own) + 1, dtype=np.uint64)
    name = mix(np.array([np.bitwise_xor.reduce(mix(own * _U(2) + at)) + _U(len(own))], np.uint64))
    return name.view(np.int64)


def frequency_sketch(docs: DataFrame, n: int = WORDS) -> np.ndarray:
    """How many documents hold a shingle, by its low SKETCH_BITS bits: counters over all documents."""
    size = 1 << SKETCH_BITS
    part = size // SKETCH_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int32)
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                for _, own in _sets(piece, n):
                    np.add.at(seen, (own & _U(size - 1)).view(np.int64), 1)
        # a task's counter stops at 255, which keeps frequent shingles frequent and the blocks small
        few = np.minimum(seen, 255).astype(np.uint8).reshape(SKETCH_PARTS, part)
        for p in np.flatnonzero(few.any(1)):
            yield pa.record_batch({"part": pa.array([p], pa.int32()), "counts": pa.array([zlib.compress(few[p].tobytes(), 1)], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, blob in zip(batch.column("part").to_pylist(), batch.column("counts")):
                own = np.frombuffer(zlib.decompress(blob.as_buffer()), np.uint8)
                if p not in sums:
                    sums[p] = np.zeros(part, np.int64)
                sums[p] += own
        for p, own in sums.items():
            yield pa.record_batch({"part": pa.array([p], pa.int32()), "counts": pa.array([np.minimum(own, (1 << 31) - 1).astype(np.int32).tobytes()], pa.binary())})

    shape = "part int, counts binary"
    rows = docs.select("text").mapInArrow(count, shape).repartition("part").mapInArrow(add, shape).collect()
    out = np.zeros((SKETCH_PARTS, part), np.int32)
    for row in rows:
        out[row["part"]] = np.frombuffer(row["counts"], np.int32)
    return out.reshape(-1)


def _place(value: Column) -> Column:
    return F.pmod(value, F.lit(1 << MARK_BITS))


def _marks(ids: DataFrame, place: Column) -> np.ndarray:
    """A bitmap of 2**MARK_BITS bits with the places of ``ids``."""
    words = (ids.select(place.alias("h")).groupBy(F.shiftright("h", 5).cast("int").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(h & 31 as int)))").alias("bits")).toArrow())
    out = np.zeros(1 << MARK_BITS - 5, np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def _is_marked(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return ((bits[place >> 5] >> (place & 31).astype(np.uint32)) & np.uint32(1)).astype(bool)


def _marked(rows: DataFrame, ids: DataFrame, key: str, then: Callable | None = None, shape: str = "") -> DataFrame:
    """Rows whose ``key`` may be among ``ids``: what is surely not goes before any shuffle.

    ``then`` makes rows of ``shape`` of a batch of them, in the same worker.
    """
    marks, columns = rows.sparkSession.sparkContext.broadcast(_marks(ids, _place(F.xxhash64(key)))), rows.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = marks.value
        for batch in batches:
            kept = batch.select(columns).filter(pa.array(_is_marked(bits, batch.column("h").to_numpy())))
            yield from then(kept) if then else (kept,)

    hashed = rows.where(F.col(key).isNotNull()).withColumn("h", _place(F.xxhash64(key)))
    return hashed.mapInArrow(keep, shape or rows.schema)


def _prefix(size: np.ndarray | int, percent: int):
    return size - -(-size * percent // 100) + 1


def _prepare(sketch: Callable[[], np.ndarray], n: int, percent: int):
    """Rows (doc_id, n_shingles, node, first, last, second): prefixes only where a task meets a node first, with an id.

    ``last`` is the place of the first prefix's end in order one, up to the lower half of the hash.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()),
                        ("first", pa.list_(pa.int64())), ("last", pa.int64()), ("second", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, met = sketch(), set()
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                sizes, nodes = np.zeros(piece.num_rows, np.int64), np.full(piece.num_rows, -1, np.int64)
                first: list = [None] * piece.num_rows
                second: list = [None] * piece.num_rows
                last: list = [None] * piece.num_rows
                named = piece.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                for row, own in _sets(piece, n):
                    sizes[row], nodes[row] = len(own), _node(own)[0]
                    if not named[row] or nodes[row] in met:
                        continue
                    met.add(nodes[row])
                    keep = _prefix(len(own), percent)
                    rank = counts[(own & _U((1 << SKETCH_BITS) - 1)).astype(np.int64)]
                    chosen = np.lexsort((own, rank))[:keep]
                    first[row] = own[chosen].view(np.int64)
                    last[row] = int(rank[chosen[-1]]) << 32 | int(own[chosen[-1]]) >> 32
                    second[row] = _second(own, percent).tobytes()
                yield pa.record_batch([piece.column("doc_id"), pa.array(sizes), pa.array(nodes),
                                       pa.array(first, schema.field("first").type), pa.array(last, pa.int64()), pa.array(second, pa.binary())], schema=schema)

    return run


def _second(own: np.ndarray, percent: int) -> np.ndarray:
    """The prefix under order two, as upper halves of the hashes: own is sorted by hash."""
    return (own[: _prefix(len(own), percent) + EXTRA] >> _U(32)).astype(np.uint32)


def _shared_needed(a: int, b: int, percent: int) -> int:
    """Shingles that two sets of these sizes have in common at least, if they link."""
    return -(-percent * (a + b) // (100 + percent))


def _passes_second(a: np.ndarray, na: int, b: np.ndarray, nb: int, percent: int) -> bool:
    """Order two: of the common shingles, only so many can lie beyond a prefix's end.

    In front of the smaller of both prefixes' last hashes, both prefixes are complete.  At most the
    rest of the smaller remainder is common beyond it, so the others must be common in front of it.
    """
    end = min(int(a[-1]) if len(a) < na else 1 << 32, int(b[-1]) if len(b) < nb else 1 << 32)
    front_a, front_b = a[a < end], b[b < end]
    beyond = min(na - len(front_a), nb - len(front_b))
    common = int(np.isin(front_a, front_b).sum())
    return common + beyond >= _shared_needed(na, nb, percent)


def _pairs_kernel(check: Callable):
    """Streams rows sorted by (a, salt, lead): a's own row comes before its partners'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, None
        for batch in batches:
            got_a, got_b, got_v = [], [], []
            cols = (batch.column("a").to_pylist(), batch.column("salt").to_pylist(), batch.column("b").to_pylist(),
                    batch.column("size").to_pylist(), batch.column("body"))
            for a, salt, b, size, body in zip(*cols):
                own = (size, body.as_buffer())
                if b is None:
                    held_key, held = (a, salt), own
                elif held_key == (a, salt) and check(held, own):
                    got_a.append(a)
                    got_b.append(b)
            yield pa.record_batch({"a": pa.array(got_a, pa.int64()), "b": pa.array(got_b, pa.int64())})

    return run


def _compare(pairs: DataFrame, bodies: DataFrame, check: Callable, salts: int = 16) -> DataFrame:
    """Pairs (a, b) that ``check`` accepts on the bodies (node, size, body) of both.

    Rows are sorted so that a's body precedes those of its partners; a holds for one salt at a
    time, so a hub's partners are spread over ``salts`` tasks and a task keeps one body.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int"))
    partner = salted.join(bodies.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "size", "body")
    lead = (salted.select("a", "salt").distinct().join(bodies.withColumnRenamed("node", "a"), "a")
            .select("a", "salt", F.lit(None).cast("long").alias("b"), "size", "body"))
    return (
        partner.union(lead).repartition("a", "salt")
        .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
        .mapInArrow(_pairs_kernel(check), "a long, b long")
    )


def _allowed(x: Column, y: Column, percent: int) -> Column:
    """Sizes and bounds let x and y link."""
    a, b = x["size"], y["size"]
    reach = (F.when(x["last"] < y["last"], x["most"]).when(y["last"] < x["last"], y["most"])
             .otherwise(F.greatest(x["most"], y["most"])))
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & ((100 + percent) * reach >= percent * (a + b))


def _size_class(size: Column, percent: int) -> Column:
    """Sets that link are of the same class of size or of neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / math.log(100 / percent + 1e-6)).cast("int")


def _enough(x: Column, y: Column, common: Column, percent: int) -> Column:
    """Of the prefix that ends earlier, ``common`` shingles at most are common; behind it, all may be."""
    a, b = x["size"], y["size"]
    size = F.when(x["last"] < y["last"], a).when(y["last"] < x["last"], b).otherwise(F.greatest(a, b))
    return (100 + percent) * (common + F.ceil(percent * size / 100) - 1) >= percent * (a + b)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def join_components(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counters = spark.sparkContext.broadcast(frequency_sketch(texts, n))
    prepared = stage(texts.mapInArrow(
        _prepare(lambda: counters.value, n, percent),
        "doc_id long, n_shingles long, node long, first array<long>, last long, second binary"), "join-sets")

    # dealt by shingle once and sorted, without a table of all shingles in memory; most stand alone
    posted = prepared.where("first is not null").select("node", F.explode("first").alias("shingle"))
    same = Window.partitionBy("shingle")
    met = posted.withColumns({"low": F.min("node").over(same), "high": F.max("node").over(same)}).where("low < high")
    met = stage(met.select("shingle", "node").distinct(), "join-met")
    lists = met.groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high"), F.bit_xor(F.xxhash64("node")).alias("all"))
    lists = stage(lists.where("low < high"), "join-lists")
    shared = met.join(lists.select("shingle"), "shingle", "left_semi")
    held = prepared.where("first is not null").select("node", "n_shingles", "doc_id", "last", "second", F.size("first").alias("n_first"))
    nodes = stage(
        _marked(held, shared, "node").join(shared.groupBy("node").agg(
            F.count("*").alias("n_shared"), F.sort_array(F.collect_list("shingle")).alias("own")), "node")
        .groupBy("node").agg(
            F.first("n_shingles").alias("size"), F.first("second").alias("body"), F.min("doc_id").alias("doc_id"),
            F.first("last").alias("last"), F.first("own").alias("own"), (F.first("n_shingles") - F.first("n_first") + F.first("n_shared")).alias("most")),
        "join-nodes")
    kept = lists.groupBy("n", "low", "high", "all").agg(F.min("shingle").alias("shingle")).select("shingle")
    # a node's own figures travel with its postings: x.node, x.size, x.last, x.most
    postings = stage(
        met.join(kept, "shingle").join(nodes.select("node", "size", "last", "most"), "node")
        .select("shingle", "node", F.struct("node", "size", "last", "most").alias("x")), "join-postings")
    second = nodes.select("node", "size", "body")

    def light(a, b) -> bool:
        return _passes_second(np.frombuffer(a[1], np.uint32), a[0], np.frombuffer(b[1], np.uint32), b[0], percent)

    def full(a, b) -> bool:
        same = len(np.intersect1d(np.frombuffer(a[1], np.uint64), np.frombuffer(b[1], np.uint64), assume_unique=True))
        return 100 * same >= percent * (a[0] + b[0] - same)

    def bodies(wanted: DataFrame) -> Callable:
        """Sets of texts whose node may be wanted; a set too many is joined with no pair."""
        marks = spark.sparkContext.broadcast(_marks(wanted, _place(F.col("node"))))

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for piece in slices(batch, "text", SLICE):
                got = [(_node(own), own) for _, own in _sets(piece, n)]
                got = [(name[0], len(own), own.tobytes()) for name, own in got if _is_marked(marks.value, name % (1 << MARK_BITS))[0]]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in got], kind) for k, kind in
                                                  enumerate((pa.int64(), pa.int64(), pa.binary()))], ["node", "size", "body"])

        return run

    def verified(pairs: DataFrame) -> DataFrame:
        """Order two, then whole sets: from (a, b) to the links among them."""
        left = stage(_compare(pairs, second, light), "join-candidates")
        asked = left.select(F.col("a").alias("node")).union(left.select(F.col("b").alias("node"))).distinct()
        wanted = stage(nodes.join(asked, "node", "left_semi").select("node", "doc_id"), "join-wanted")
        # one worker a task: the rows are found and made to sets in it, without a join in between
        sets = stage(_marked(texts, wanted, "doc_id", bodies(wanted), "node long, size long, body binary"), "join-bodies").dropDuplicates(["node"])
        return stage(_compare(left, sets, full), "join-links")

    grouped = postings.withColumn("comp", F.col("node"))
    links, tried, merged = None, None, None
    for turn in range(STARS + 1):
        if merged is not None:
            grouped = postings.join(merged, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
        if turn == 0:
            lead = F.struct((F.col("x.size") - F.col("x.most")) / F.col("x.size"), F.xxhash64("node"))
        else:
            lead = F.struct(F.xxhash64("node", F.lit(turn)), F.col("node"))
        spans = (grouped.groupBy("shingle").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"),
            F.min_by(F.struct("x", "comp"), lead).alias("centre")).where("low < high"))
        if turn < STARS:
            pairs = (grouped.join(spans.select("shingle", F.col("centre.x").alias("y"), F.col("centre.comp").alias("comp2")), "shingle")
                     .where(F.col("comp") != F.col("comp2")))
        else:
            # of a pair's first shared shingle, all it shares come behind: the part in front need not travel
            # it travels as upper halves of the hashes; ``lost`` of them are equal to another one's
            halves = F.transform(F.filter("own", lambda v: v >= F.col("shingle")), lambda v: F.shiftright(v, 32).cast("int"))
            own = F.array_distinct("halves").alias("own")
            open_ = stage(grouped.join(spans.select("shingle"), "shingle").join(nodes.select("node", "own"), "node")
                          .withColumn("halves", halves).select("shingle", "x", "comp", own, (F.size("halves") - F.size(own)).alias("lost"), _size_class(F.col("x.size"), percent).alias("class")), "join-open")
            other = open_.select("shingle", F.col("x").alias("y"), F.col("comp").alias("comp2"), F.col("own").alias("own2"), F.col("lost").alias("lost2"),
                                 F.col("class").alias("class2"), F.explode(F.array(F.col("class"), F.col("class") - 1)).alias("class"))
            common = F.size(F.array_intersect("own", "own2")) + F.least("lost", "lost2")
            apart = F.when(F.col("class") == F.col("class2"), F.col("comp") < F.col("comp2")).otherwise(F.col("comp") != F.col("comp2"))
            pairs = open_.join(other, ["shingle", "class"]).where(
                apart & _allowed(F.col("x"), F.col("y"), percent)
                & _enough(F.col("x"), F.col("y"), common, percent))
        pairs = pairs.where(_allowed(F.col("x"), F.col("y"), percent)).select(
            F.col("x.node").alias("node"), F.col("y.node").alias("other"))
        pairs = _ordered(pairs.select(F.col("node").alias("a"), F.col("other").alias("b")))
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage(pairs, "join-pairs")
        if pairs.isEmpty():
            # a round without a proposal says nothing of the pairs that it did not look at
            if spans.isEmpty():
                break
            continue
        found = verified(pairs)
        tried = pairs if tried is None else tried.union(pairs)
        links = found if links is None else links.union(found)
        merged = stage(components(links), "join-components")

    least = prepared.where("node != -1 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    if merged is None:
        return prepared.join(least, "node", "left").select(
            "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))
    names = least.join(merged, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = names.groupBy("component").agg(F.min("least").alias("component_id"))
    named = names.join(lowest, "component").select("node", "component_id")
    return prepared.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
