"""JSON texts cut into their top-level objects in parallel, whatever the line breaks.

A file is read in pieces that end at a ``}``, so that Spark splits it by byte ranges, even an array on
one line.  A piece alone does not tell whether it starts inside a string or how deep it is nested.
The first scan therefore finds, for either start, how each split changes both: an escape never crosses a
piece, as ``\\}`` is no escape.  Window sums over one row per split give every split its true start.
The second scan cuts the objects out; the part of an object at either end of a split is put together with the parts in the
splits beside it.

An object is top-level where nothing is open around it but the array that the file, or the first part file, starts with.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.session import settle

END = "}"
# brackets that open are 1, those that close -1, quotes 2
_KIND = np.zeros(256, np.int8)
_KIND[[ord("{"), ord("[")]] = 1
_KIND[[ord("}"), ord("]")]] = -1
_KIND[ord('"')] = 2

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", END).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("file_size"))


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where brackets and quotes are, the quotes that open or close a string up to each, and how each changes the depth outside strings."""
    kind = _KIND[data]
    at = np.flatnonzero(kind)
    kind = kind[at]
    quotes = kind == 2
    slashes = data == 92
    if slashes.any():
        every = np.arange(len(data))
        # length of the run of backslashes that ends before each byte
        before = np.concatenate(([-1], np.maximum.accumulate(np.where(slashes, -1, every))[:-1]))
        quotes &= ((every - 1 - before) % 2 == 0)[at]
    return at, np.cumsum(quotes, dtype=np.int32), np.where(kind == 2, 0, kind)


def _texts(column: pa.StringArray, low: int, high: int) -> np.ndarray:
    """The bytes of these pieces, an end behind each."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset + low: column.offset + high + 1]
    first, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    out = np.full(size + high - low, ord(END), np.uint8)
    if size:
        own = np.ones(len(out), bool)
        own[(offsets[1:] - first) + np.arange(high - low)] = False
        out[own] = np.frombuffer(column.buffers()[2], np.uint8)[first: first + size]
    return out


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
    """(file, start, ...) and the bytes of neighbouring pieces of a split, in order; an end is added behind every piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("value").cast(pa.string())
        names = [f for f in batch.schema.names if f != "value"]
        split = batch.column("file").dictionary_encode().indices.to_numpy()
        starts = batch.column("start").to_numpy()
        cuts = np.flatnonzero((np.diff(split) != 0) | (np.diff(starts) != 0)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(column)]):
            yield tuple(batch.column(c)[low].as_py() for c in names), _texts(column, low, high)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, file_size, n_bytes, odd, outside, inside, first): what a split does to strings and depth from either start."""
    held, total = None, None

    def row() -> pa.RecordBatch:
        names = ["file", "start", "file_size", "n_bytes", "odd", "outside", "inside", "first"]
        return pa.RecordBatch.from_pylist([dict(zip(names, (*held, *total)))], schema=_SUMMARY)

    for key, data in _splits(batches):
        if key != held:
            if held is not None:
                yield row()
            held, total = key, [0, 0, 0, 0, None]
        _, quotes, step = _marks(data)
        closed = quotes % 2 == 0
        even, odd = int(step[closed].sum()), int(step[~closed].sum())
        total[0] += len(data)
        # what is outside strings from one start is inside them from the other
        if total[1]:
            even, odd = odd, even
        total[2], total[3] = total[2] + even, total[3] + odd
        total[1] = (total[1] + int(quotes[-1])) % 2
        if total[4] is None:
            solid = data[~np.isin(data, (9, 10, 13, 32))]
            total[4] = chr(solid[0]) if len(solid) else None
    if held is not None:
        yield row()


_SUMMARY = pa.schema([("file", pa.string()), ("start", pa.int64()), ("file_size", pa.int64()), ("n_bytes", pa.int64()), ("odd", pa.int64()),
                      ("outside", pa.int64()), ("inside", pa.int64()), ("first", pa.string())])
_SUMMARY_SQL = "file string, start long, file_size long, n_bytes long, odd long, outside long, inside long, first string"


def split_states(spark: SparkSession, path: str | list[str], concatenated: bool = False) -> DataFrame:
    """(file, start, in_string, depth, base, extra): the true start of each split, one row a split.

    ``base`` is the depth at which objects are top-level; ``extra`` marks a split whose last end the file does not have.
    With ``concatenated``, all files are one text in the order of their names.  Fails if a text does not end as it must.
    """
    found = settle(_pieces(spark, path).mapInArrow(_summaries, _SUMMARY_SQL), "json-splits")
    file = Window.partitionBy("file")
    text = (F.lit("") if concatenated else F.col("file")).alias("text")
    order = Window.partitionBy("text").orderBy("file", "start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    known = found.select("*", text).withColumn("in_string", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1)
    # the end that was added to a file's last piece may be none of its bytes; a file on its own shows that by its depth
    change = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    surplus = F.sum("n_bytes").over(file) > F.col("file_size") if concatenated else F.sum("change").over(file) == -1
    known = known.withColumn("change", change).withColumn("extra", (F.col("start") == F.max("start").over(file)) & surplus)
    ends_open = (F.col("in_string").cast("int") + F.col("odd")) % 2 == 1
    change = F.col("change") + F.when(F.col("extra") & ~ends_open, 1).otherwise(0)
    base = F.when(F.first("first", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == "[", 1).otherwise(0)
    states = known.withColumn("change", change).select(
        "file", "start", "text", "in_string", "extra", F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("depth"), base.alias("base"),
        F.sum("change").over(Window.partitionBy("text")).alias("total"), (F.sum("odd").over(Window.partitionBy("text")) % 2).alias("open"))
    bad = states.where("total != 0 or open != 0").select("file").take(1)
    if bad:
        raise ValueError(f"no complete JSON text: {bad[0]['file']}")
    return states.drop("total", "open")


def _objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, part, value): whole objects (part 1), the end of an earlier split's object (0), the begin of one (2)."""
    held = None
    state: dict = {}

    def rows(found: list[tuple[int, str]]) -> pa.RecordBatch:
        file, start = held[0], held[1]
        n = len(found)
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(file, pa.string()), n), pa.repeat(pa.scalar(start, pa.int64()), n),
                                           pa.array([p for p, _ in found], pa.int32()), pa.array([t for _, t in found], pa.string())],
                                          ["file", "start", "part", "value"])

    def feed(data: np.ndarray) -> list[tuple[int, str]]:
        at, quotes, step = _marks(data)
        inside = (quotes + state["in_string"]) % 2 == 1
        step = np.where(inside, 0, step)
        depth = state["depth"] + np.cumsum(step, dtype=np.int64)
        base, sign = state["base"], data[at]
        opens = at[(step == 1) & (depth == base + 1) & (sign == 123)]
        closes = at[(step == -1) & (depth == base) & (sign == 125)] + 1
        out = []
        if state["open"]:
            if not len(closes):
                state["carry"].append(data.tobytes())
                opens = opens[:0]
            else:
                whole = b"".join([*state["carry"], data[: closes[0]].tobytes()])
                out.append((0 if state["open"] == "before" else 1, whole.decode()))
                state["open"], state["carry"] = None, []
                closes = closes[1:]
        if not state["open"]:
            raw = data.tobytes()
            for low, high in zip(opens.tolist(), closes.tolist()):
                out.append((1, raw[low:high].decode()))
            if len(opens) > len(closes):
                state["open"], state["carry"] = "here", [raw[int(opens[-1]):]]
        if len(at):
            state["in_string"] = int(inside[-1])
            state["depth"] = int(depth[-1])
        return out

    def last() -> list[tuple[int, str]]:
        """What is left at the end of a split; an end that was held back is none of the file's bytes."""
        out = []
        if state["open"]:
            out.append((0 if state["open"] == "before" else 2, b"".join(state["carry"]).decode()))
        return out

    for key, data in _splits(batches):
        if key != held:
            if held is not None:
                yield rows(last())
            held = key
            in_string, extra, depth, base = key[2:]
            state = {"in_string": int(in_string), "depth": depth, "base": base, "carry": [], "late": b"",
                     "open": "before" if depth > base else None, "extra": extra}
        # where the file lacks the last end, each is held back until another piece follows
        whole = state["late"] + data.tobytes()
        now, state["late"] = (whole[:-1], whole[-1:]) if state["extra"] else (whole, b"")
        if now:
            found = feed(np.frombuffer(now, np.uint8))
            if found:
                yield rows(found)
    if held is not None:
        yield rows(last())


def json_objects(spark: SparkSession, path: str | list[str], concatenated: bool = False) -> DataFrame:
    """(value): the text of each top-level object of arrays or of objects that follow each other."""
    states = split_states(spark, path, concatenated)
    # one row a split, as in a listing of splits; each task needs those of its own
    placed = _pieces(spark, path).drop("file_size").join(F.broadcast(states.drop("text")), ["file", "start"]).select(
        "value", "file", "start", "in_string", "extra", "depth", "base")
    cut = placed.mapInArrow(_objects, "file string, start long, part int, value string")
    return _whole(cut, concatenated)


def _whole(cut: DataFrame, concatenated: bool) -> DataFrame:
    """Objects in one piece, and those whose parts lie in several splits: one row a part, of which a split has two at most."""
    cut = settle(cut, "json-objects")
    text = (F.lit("") if concatenated else F.col("file")).alias("text")
    order = Window.partitionBy("text").orderBy("file", "start", "part")
    parts = cut.where("part != 1").select("*", text).withColumn("number", F.sum((F.col("part") == 2).cast("int")).over(order))
    joined = parts.groupBy("text", "number").agg(F.array_sort(F.collect_list(F.struct("file", "start", "part", "value"))).alias("p"))
    return cut.where("part = 1").select("value").union(joined.select(F.array_join("p.value", "").alias("value")))
