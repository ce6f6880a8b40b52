"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

A benchmark item of L words is compared with every window of L words of a document that can hold a
copy of it: one that holds at least one of the benchmark's five-word shingles, since windows without
any have similarity 0.  A document of fewer words is one window as a whole.  Windows and items get a 64-bit SimHash of their weighted shingles, each
distinct shingle once: running sums give a window's, less the repeats within it.  The fingerprint is cut into 8 blocks of 8 bits: fingerprints within RADIUS = 23 bits agree up to 2 bits in at
least one block, so looking up all values within 2 bits in every block finds all of them.
Candidates within the radius are checked exactly: weighted Jaccard similarity of the shingle sets,
at least 0.8.  A shingle weighs ``ln(1 + items / items that hold it)``; one that no item holds
weighs as one that a single item holds.

A document is compared with items that share a shingle with it only; lists of each shingle's items give them, so that
the work of a document does not grow with the number of other items.

The benchmark is a query set in blocks of about ``BLOCK_WORDS`` words.  A task per block builds its index and writes it to
the shared folder; nothing of an item passes through the driver.  Documents are read once, whole, and never shuffled:
a worker hashes a slice of texts and goes through the blocks with it, holding one index at a time, in turns forwards and
backwards, so that a single block is loaded once.  Files have names of their own attempt and are reported, so a lost executor leaves nothing that counts.

Defined results: null and empty texts and items match nothing; an item or document of fewer than
five words is one shingle as a whole, so such an item matches only a document equal to it; repeated
documents and items each give their rows, as do those with null ids; ``clean_documents`` judges each row by its
text, whatever its id is; empty tables give no rows; other columns are ignored, and kept by ``clean_documents``.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.shared import file_system, new_folder, stage, word_count
from leafmill.llm.words import mix, shingles, slices, words

WORDS, SIMILARITY = 5, 0.8
BLOCKS, NEAR_BITS = 8, 2
RADIUS = BLOCKS * (NEAR_BITS + 1) - 1
BLOCK_WORDS = 2_000_000
SLICE_BYTES = 16 << 20
_LEAKS = "doc_id long, item_id long, similarity double, first_word long, n_words long"
_BITMAP_BITS = 22
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_U = np.uint64


def _signs(value: np.ndarray) -> np.ndarray:
    """(n, 64) of +1 and -1: the bits of remixed shingle hashes."""
    bits = np.unpackbits(mix(value ^ _U(0xA5A5A5A5A5A5A5A5)).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """(n, 8) bytes: the signs of weighted sums, equal ones whatever the order of addition."""
    return np.packbits(np.round(sums, 9) > 0, axis=1)


def _running(x: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros((1, x.shape[1])), np.cumsum(x, 0)))


@dataclass(frozen=True)
class ItemIndex:
    """One block of items: known shingles with weights, and per item length the multi-index."""

    bitmap: np.ndarray
    known: np.ndarray
    weight: np.ndarray
    rare: float
    #: items that hold the known shingle k: held_by[starts[k]:starts[k + 1]], by their number
    starts: np.ndarray
    held_by: np.ndarray
    #: length -> numbers of the items, their fingerprints, blocks near them, sets, weights
    by_length: dict

    @classmethod
    def of(cls, texts: pa.Array, n: int, n_items: int, held: dict) -> ItemIndex:
        hashes, begin = words(texts)
        value, bounds = shingles(hashes, begin, n)
        known = np.unique(value)
        counts = np.array([held[x] for x in known.tolist()], float)
        weight = np.log1p(n_items / counts)
        bitmap = np.zeros(1 << _BITMAP_BITS, bool)
        bitmap[(known & _U((1 << _BITMAP_BITS) - 1)).astype(np.int64)] = True
        sizes = np.diff(begin)
        number = np.repeat(np.arange(len(sizes)), np.diff(bounds))
        pair = np.unique(np.searchsorted(known, value) * max(len(sizes), 1) + number)
        starts = np.searchsorted(pair, np.arange(len(known) + 1) * max(len(sizes), 1))
        by_length = {}
        for length in np.unique(sizes[sizes > 0]).tolist():
            rows = np.flatnonzero(sizes == length)
            sets = [np.unique(value[bounds[r]: bounds[r + 1]]) for r in rows]
            weights = [weight[np.searchsorted(known, s)] for s in sets]
            prints = np.concatenate([_pack((w[:, None] * _signs(s)).sum(0)[None]) for s, w in zip(sets, weights)])
            near = np.zeros((BLOCKS, 256, len(rows)), bool)
            for b in range(BLOCKS):
                near[b] = _POPCOUNT[np.arange(256)[:, None] ^ prints[None, :, b]] <= NEAR_BITS
            by_length[length] = (rows, prints, near, sets, [float(w.sum()) for w in weights])
        return cls(bitmap, known, weight, float(np.log1p(n_items)), starts, pair % max(len(sizes), 1), by_length)

    def lookup(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where known, which known shingles)."""
        maybe = np.flatnonzero(self.bitmap[(value & _U((1 << _BITMAP_BITS) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, value[maybe]), len(self.known) - 1)
        good = self.known[at] == value[maybe]
        return maybe[good], at[good]

    def holders(self, known: np.ndarray) -> np.ndarray:
        """Numbers of the items that hold any of the known shingles; all others have nothing in common with them."""
        known = np.unique(known)
        size = self.starts[known + 1] - self.starts[known]
        at = np.repeat(self.starts[known] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
        return np.unique(self.held_by[at])


def _search(index: ItemIndex, value: np.ndarray, hits: np.ndarray, shared: np.ndarray, n: int, n_words: int,
            similarity: float) -> Iterator[tuple[int, float, int, int]]:
    """(item's number, similarity, first word, words) of the best window of each item in one document."""
    best: dict[int, tuple[float, int, int]] = {}
    hit_weights = index.weight[shared]
    # only items that share a shingle with the document are looked at, however many there are
    asked = index.holders(shared)
    # only shingles near a known one can be in a window that holds one
    widest = max(max(1, length - n + 1) for length in index.by_length)
    close = np.bincount(np.maximum(hits - widest, 0), minlength=len(value) + 1)
    close = np.cumsum(close - np.bincount(np.minimum(hits + widest, len(value)), minlength=len(value) + 1))
    at = np.flatnonzero(close[:-1] > 0)
    place = np.searchsorted(at, hits)
    value, weights, known = value[at], np.full(len(at), index.rare), np.zeros(len(at) + 1)
    weights[place] = hit_weights
    known[place + 1] = hit_weights
    known = np.cumsum(known)
    # running sums of signs, once for all lengths
    signs = weights[:, None] * _signs(value)
    sums = _running(signs)
    # places of repeated shingles, and of each one's occurrence before
    order = np.argsort(value, kind="stable")
    same = np.flatnonzero(value[order[1:]] == value[order[:-1]])
    again, before = order[same + 1], order[same]
    for length, (numbers, prints, near, sets, totals) in index.by_length.items():
        mine = np.flatnonzero(np.isin(numbers, asked, assume_unique=True)).tolist()
        if not mine:
            continue
        # a document shorter than the item is one window as a whole
        size = min(length, n_words)
        wide = max(1, size - n + 1)
        if wide > len(at) or (size < n and n_words != length):
            continue
        # a window is of neighbours, and can share no more than its known shingles weigh
        fits = (at[wide - 1:] - at[: len(at) - wide + 1] == wide - 1) & (known[wide:] - known[:-wide] >= (similarity - 1e-9) * min(totals[i] for i in mine))
        first = np.flatnonzero(fits)
        if not len(first):
            continue
        window = sums[first + wide] - sums[first]
        inner = np.flatnonzero(again - before < wide)
        if len(inner):
            # a window holds a repeat if it starts in (place - wide, place before]
            opens, closes = inner[np.argsort(again[inner])], inner[np.argsort(before[inner])]
            window = (window - _running(signs[again[opens]])[np.searchsorted(again[opens] - wide, first, side="left")]
                      + _running(signs[again[closes]])[np.searchsorted(before[closes], first, side="left")])
        window = _pack(window)
        pairs = []
        for i in mine:
            candidate = near[0, window[:, 0], i]
            for b in range(1, BLOCKS):
                candidate = candidate | near[b, window[:, b], i]
            own = np.flatnonzero(candidate)
            apart = _POPCOUNT[window[own] ^ prints[i]].sum(1, dtype=np.int64)
            pairs += [(d, i, w) for d, w in zip(apart.tolist(), own.tolist()) if d <= RADIUS]
        for _, i, w in sorted(pairs):
            # the nearest first: nothing is better than equal, and of equal ones the first is kept
            item = int(numbers[i])
            if best.get(item, (0.0,))[0] >= 1.0 - 1e-12:
                continue
            own, where = np.unique(value[first[w]: first[w] + wide], return_index=True)
            own_weights = weights[first[w] + where]
            common = float(own_weights[np.isin(own, sets[i], assume_unique=True)].sum())
            alike = common / (float(own_weights.sum()) + totals[i] - common)
            if alike >= similarity - 1e-12 and alike > best.get(item, (0.0,))[0]:
                best[item] = (alike, int(at[first[w]]), size)
    for item, (alike, start, size) in best.items():
        yield item, min(alike, 1.0), start, size


class _Blocks:
    """The written indexes, one in memory at a time."""

    def __init__(self, folder: str, files: list[str]):
        self.folder, self.files, self.name, self.held = folder, files, None, None

    def __iter__(self) -> Iterator[tuple[ItemIndex, list]]:
        """All (index, item ids); the last one asked for comes last this time and first the next."""
        for name in self.files:
            if name != self.name:
                self.held = None
                fs, base = file_system(self.folder)
                with fs.open_input_stream(f"{base}/{name}", compression=None) as source:
                    fields, ids = pickle.loads(source.read())
                self.name, self.held = name, (ItemIndex(*fields), ids)
            yield self.held
        self.files = self.files[::-1]


def _match(folder: str, files: list[str], n: int, similarity: float):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()),
                        ("first_word", pa.int64()), ("n_words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(folder, files)
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES if len(files) > 1 else SLICE_BYTES // 4):
                hashes, begin = words(piece.column("text"))
                value, bounds = shingles(hashes, begin, n)
                docs, out = piece.column("doc_id").to_pylist(), []
                for index, ids in blocks:
                    hits, shared = index.lookup(value)
                    rows = np.searchsorted(bounds, hits, side="right") - 1
                    cuts = np.append(np.flatnonzero(np.diff(rows, prepend=-1)), len(rows))
                    for start, end in zip(cuts[:-1], cuts[1:]):
                        row, own = rows[start], slice(start, end)
                        low, high = bounds[row], bounds[row + 1]
                        out += [(docs[row], ids[x[0]], *x[1:]) for x in _search(
                            index, value[low:high], hits[own] - low, shared[own], n, int(begin[row + 1] - begin[row]), similarity)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in out], f.type) for k, f in enumerate(schema)], schema=schema)

    return run


def _write_index(folder: str, n: int, n_items: int):
    def run(items: pa.Table, counts: pa.Table) -> pa.Table:
        files = []
        if items.num_rows:
            items = items.sort_by([("item_id", "ascending"), ("text", "ascending")])
            held = dict(zip(counts["shingle"].to_numpy().view(np.uint64).tolist(), counts["items"].to_pylist()))
            index = ItemIndex.of(items["text"].combine_chunks(), n, n_items, held)
            fs, base = file_system(folder)
            fs.create_dir(base, recursive=True)
            files.append(f"items-{items['block'][0].as_py()}-{uuid.uuid4().hex}.bin")
            fields = tuple(getattr(index, f) for f in ItemIndex.__dataclass_fields__)
            with fs.open_output_stream(f"{base}/{files[0]}", compression=None) as sink:
                sink.write(pickle.dumps((fields, items["item_id"].to_pylist()), protocol=5))
        return pa.table({"file": pa.array(files, pa.string())})

    return run


def _index_files(benchmark: DataFrame, n: int) -> tuple[str, list[str]]:
    """Folder and names of the written indexes of all items, one file per block."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").withColumn("words", word_count(F.col("text")))
    total = items.agg(F.count("*").alias("items"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    folder = new_folder(benchmark.sparkSession, "benchmark")
    n_blocks = -(-total["words"] // BLOCK_WORDS)
    if not n_blocks:
        return folder, []
    # items are dealt to blocks by a hash
    block = F.pmod(F.xxhash64("text", "item_id"), F.lit(n_blocks)).cast("int").alias("block")
    blocks = items.where("words > 0").select(block, "item_id", "text")
    own = stage(blocks.select("block", "text").mapInArrow(lambda batches: _distinct_shingles(batches, n), "block int, shingle long"),
                "benchmark-shingles")
    held = own.groupBy("shingle").agg(F.count("*").alias("items"))
    counts = own.distinct().join(held, "shingle").select("block", "shingle", "items")
    files = stage(blocks.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(
        _write_index(folder, n, total["items"]), "file string"), "benchmark-files")
    return folder, sorted(r["file"] for r in files.collect())


def _distinct_shingles(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """(block, shingle) of each distinct shingle of each item."""
    for batch in batches:
        value, bounds = shingles(*words(batch.column("text")), n)
        sets = [np.unique(value[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        block = np.repeat(batch.column("block").to_numpy(), [len(x) for x in sets])
        yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.array(flat.view(np.int64))], ["block", "shingle"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): each item's best window in each document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    folder, files = _index_files(benchmark, n)
    if not files:
        return docs.sparkSession.createDataFrame([], _LEAKS)
    return texts.mapInArrow(_match(folder, files, n, similarity), _LEAKS)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a copy of an item; ids do not matter, as rows of one text fare alike."""
    key = F.xxhash64("text")
    leaks = find_leaks(docs.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("_leak_key")).distinct()
    return docs.join(leaks, key == F.col("_leak_key"), "left_anti")
