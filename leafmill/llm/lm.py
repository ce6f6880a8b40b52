"""Interpolated modified Kneser-Ney language model of words, order two, as sorted hash arrays.

*Counting.*  Tasks count (context, word) pairs of their texts in sorted arrays and send them
to the shard of the context.  A shard adds them up and writes one file to the shared folder:
sorted 64-bit hashes of its pairs with their counts, and sorted contexts with their totals and the
numbers of followers seen once, twice and more.  It passes on how many contexts each word follows; word
shards add these up and write sorted words with counts and continuation counts.  The
number of shards follows the bytes of the texts, so a shard's task is of bounded size.

*Hot contexts.*  A scan before finds every context that is a HOT_SHARE-th of all tokens (and no more than
twice as many as that, in all).  Their pairs are dealt to all shards by the whole pair, and the shards'
totals and follower counts of such a context are added up afterwards and go with the model's figures, so that no word
makes a shard large.  Which contexts are found changes where pairs lie, never a probability.

*Scoring.*  Workers map the files into memory and search them with sorted blocks of the
pairs of a text slice.  Only pages that are asked for are read; nothing is shuffled or broadcast but the list of
files.  Where the shared folder is not a mounted one, a worker fetches a file once, maps it and unlinks it.

A text is its words, A-Z lower-cased, and one end; the first word follows a start.  Files are
written under a name of their own attempt and reported, so a lost executor leaves nothing that counts.

Defined results: a null or empty text is one end; without training texts every probability is
that of an unknown word, 1 / (V + 1) = 1; a null id counts as the text "" when rows are held out; repeated rows
count and score each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.shared import file_system, new_folder, stage
from leafmill.llm.words import mix, slices, words

SHARD_BYTES = 24 << 20
TASK_PAIRS = 3_000_000
#: a merge task has about one shard up to this many tasks, and several shards one after the other beyond
MERGE_TASKS = 20_000
SCORE_BYTES = 8 << 20
HOT_SHARE = 1000
_U = np.uint64
START, END = _U(0x5354415254), _U(0x454E44)
_PAIR = _U(0xD1B54A32D192ED03)


@dataclass(frozen=True)
class Model:
    """Files by shard (path, number of pairs, of contexts / words), and global figures.

    ``hot``: sorted hashes of the contexts whose pairs lie in all shards; ``hot_facts``: for each its total and
    the numbers of followers seen once, twice and more.
    """

    pairs: dict[int, tuple[str, int, int]]
    words: dict[int, tuple[str, int]]
    shards: int
    tokens: int
    types: int
    kinds: int
    discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_rest: float
    hot: np.ndarray
    hot_facts: np.ndarray


def _pairs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and words of all texts with their ends, and where each text begins."""
    hashes, begin = words(texts)
    n = len(begin) - 1
    bounds = begin + np.arange(n + 1)
    word = np.full(bounds[-1], END)
    inner = np.ones(len(word), bool)
    inner[bounds[1:] - 1] = False
    word[inner] = hashes
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[bounds[:-1]] = START
    return context, word, bounds


def _shard(x: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(x ^ _PAIR) >> _U(33)) % _U(shards)).astype(np.int64)


def _among(sorted_: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Whether each of ``asked`` is in ``sorted_``, which may be empty."""
    if not len(sorted_):
        return np.zeros(len(asked), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, asked), len(sorted_) - 1)] == asked


def _pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * _PAIR + word)


def _summed(context: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order of (context, word), with their counts."""
    order = np.lexsort((word, context))
    context, word, count = context[order], word[order], count[order]
    first = np.ones(len(word), bool)
    first[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    at = np.flatnonzero(first)
    return context[at], word[at], np.add.reduceat(count, at) if len(at) else count


def _flushed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Contexts and words of a task's texts, about TASK_PAIRS at a time."""
    held, size = [], 0
    for batch in batches:
        for piece in slices(batch, "text"):
            context, word, _ = _pairs(piece.column("text"))
            held.append((context, word))
            size += len(word)
            if size >= TASK_PAIRS:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of half a HOT_SHARE-th of the tokens of a flush, and without a context the number of these tokens.

    A context of a HOT_SHARE-th of all tokens has at least half of them in flushes that report it.
    """
    for context, _ in _flushed(batches):
        own, count = np.unique(context, return_counts=True)
        often = 2 * HOT_SHARE * count >= len(context)
        yield pa.record_batch({"context": pa.array([None, *own[often].view(np.int64).tolist()], pa.int64()),
                               "n": pa.array([len(context), *count[often].tolist()], pa.int64())})


def hot_contexts(texts: DataFrame) -> np.ndarray:
    """Sorted hashes of all contexts of a HOT_SHARE-th of the tokens of ``texts`` (text), and of some of half as many."""
    counted = stage(texts.select("text").mapInArrow(_frequent, "context long, n long").groupBy("context").agg(F.sum("n").alias("n")), "lm-hot")
    total = counted.where("context is null").agg(F.sum("n")).first()[0] or 0
    found = counted.where(F.col("context").isNotNull() & (2 * HOT_SHARE * F.col("n") >= total)).select("context").collect()
    return np.sort(np.array([r["context"] for r in found], np.int64).view(np.uint64))


def _count(shards: int, hot: np.ndarray):
    def flush(context: np.ndarray, word: np.ndarray) -> Iterator[pa.RecordBatch]:
        context, word, count = _summed(context, word, np.ones(len(word), np.int64))
        part = _shard(np.where(_among(hot, context), _pair_hash(context, word), context), shards)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[s]: cuts[s + 1]]
            c, w, k = context[own], word[own], count[own].astype(np.uint32)
            head = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
            runs = np.diff(np.append(head, len(c))).astype(np.uint32)
            yield pa.record_batch({"shard": pa.array([s], pa.int32()), "contexts": pa.array([c[head].tobytes()], pa.binary()),
                                   "runs": pa.array([runs.tobytes()], pa.binary()), "words": pa.array([w.tobytes()], pa.binary()),
                                   "counts": pa.array([k.tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for context, word in _flushed(batches):
            yield from flush(context, word)

    return run


def _save(folder: str, kind: str, shard: int, arrays: list[np.ndarray]) -> str:
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    name = f"{kind}-{shard}-{uuid.uuid4().hex}.bin"
    with fs.open_output_stream(f"{base}/{name}", compression=None) as sink:
        for a in arrays:
            sink.write(np.ascontiguousarray(a))
    return name


def _blobs(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)])


def _merge_pairs(folder: str, shards: int, hot: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        context = np.repeat(_blobs(table, "contexts", np.uint64), _blobs(table, "runs", np.uint32))
        context, word, count = _summed(context, _blobs(table, "words", np.uint64), _blobs(table, "counts", np.uint32).astype(np.int64))
        head = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
        followers = [np.add.reduceat((count == k) if k < 3 else (count >= 3), head, dtype=np.int64).astype(np.uint32) for k in (1, 2, 3)]
        total = np.add.reduceat(count, head)
        key = _pair_hash(context, word)
        order = np.argsort(key)
        arrays = [key[order], context[head], total, *followers, count[order].astype(np.uint32)]
        path = _save(folder, "pairs", shard, arrays)
        own, after = np.unique(word, return_inverse=True)
        kinds, tokens = np.bincount(after).astype(np.uint32), np.bincount(after, count).astype(np.int64)
        part = _shard(own, shards)
        by = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[by], np.arange(shards + 1))
        spread = np.flatnonzero(_among(hot, context[head]))
        facts = [{"context": int(c), "facts": [int(f[i]) for f in (total, *followers)]}
                 for i, c in zip(spread, context[head][spread].view(np.int64))]
        rows = {"path": [path], "shard": [shard], "size": [len(key)], "others": [len(head)],
                "seen": [[int((count == k).sum()) for k in (1, 2, 3, 4)]], "hot": [facts], "words": [None], "kinds": [None], "tokens": [None]}
        for s in np.flatnonzero(np.diff(cuts)):
            mine = by[cuts[s]: cuts[s + 1]]
            for c, v in (("path", None), ("shard", int(s)), ("size", None), ("others", None), ("seen", None), ("hot", None), ("words", own[mine].tobytes()),
                         ("kinds", kinds[mine].tobytes()), ("tokens", tokens[mine].astype(np.uint32).tobytes())):
                rows[c].append(v)
        shared = pa.list_(pa.struct([("context", pa.int64()), ("facts", pa.list_(pa.int64()))]))
        types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), shared, pa.binary(), pa.binary(), pa.binary())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(rows.items(), types)})

    return run


def _merge_words(folder: str):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        own, after = np.unique(_blobs(table, "words", np.uint64), return_inverse=True)
        kinds = np.bincount(after, _blobs(table, "kinds", np.uint32)).astype(np.int64)
        tokens = np.bincount(after, _blobs(table, "tokens", np.uint32)).astype(np.int64)
        path = _save(folder, "words", shard, [own, tokens, kinds])
        seen = [int((kinds == k).sum()) for k in (1, 2, 3, 4)] + [int((kinds >= 3).sum()), int(tokens.sum()), int(kinds.sum())]
        return pa.table({"path": [path], "shard": pa.array([shard], pa.int32()), "size": pa.array([len(own)], pa.int64()),
                         "seen": pa.array([seen], pa.list_(pa.int64()))})

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more; 0.5, 1 and 1.5 where a number is 0."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), k) for k, d in zip((1.0, 2.0, 3.0), found))


def train(texts: DataFrame) -> tuple[str, Model]:
    """Count a model from all of ``texts`` (text); returns its folder and its figures."""
    spark = texts.sparkSession
    folder = new_folder(spark, "lm")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    hot = hot_contexts(texts)
    counted = texts.select("text").mapInArrow(_count(shards, hot), "shard int, contexts binary, runs binary, words binary, counts binary")
    # four times as many tasks as shards, so that few shards meet in a task
    tasks = min(4 * shards, MERGE_TASKS)
    merged = stage(counted.repartition(tasks, "shard").groupBy("shard").applyInArrow(
        _merge_pairs(folder, shards, hot),
        "path string, shard int, size long, others long, seen array<long>, hot array<struct<context long, facts array<long>>>, words binary, kinds binary, tokens binary"), "lm-pairs")
    pairs = merged.where("path is not null").select("path", "shard", "size", "others", "seen").collect()
    words_ = stage(merged.where("path is null").select("shard", "words", "kinds", "tokens").repartition(tasks, "shard").groupBy("shard").applyInArrow(
        _merge_words(folder), "path string, shard int, size long, seen array<long>"), "lm-words").collect()
    shared = merged.select(F.inline("hot")).groupBy("context").agg(F.array(*(F.sum(F.col("facts")[i]) for i in range(4))).alias("facts")).collect()
    facts = {r["context"]: r["facts"] for r in shared}
    n = np.sum([r["seen"] for r in pairs], 0) if pairs else np.zeros(4, int)
    m = np.sum([r["seen"] for r in words_], 0) if words_ else np.zeros(7, int)
    d = discounts(*(int(x) for x in m[:4]))
    rest = float(d[0] * m[0] + d[1] * m[1] + d[2] * m[4])
    return folder, Model(
        {r["shard"]: (r["path"], r["size"], r["others"]) for r in pairs}, {r["shard"]: (r["path"], r["size"]) for r in words_},
        shards, int(m[5]), sum(r["size"] for r in words_), int(m[6]), discounts(*(int(x) for x in n)), d, rest,
        hot, np.array([facts[c] for c in hot.view(np.int64).tolist()], np.int64).reshape(-1, 4))


class _Maps:
    """Model files mapped into this worker's memory, each when it is first asked for."""

    def __init__(self, folder: str):
        self.uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
        self.open: dict[str, mmap.mmap] = {}

    def arrays(self, name: str, layout: list[tuple]) -> list[np.ndarray]:
        if name not in self.open:
            parsed = urlparse(self.uri)
            if parsed.scheme == "file":
                with open(f"{unquote(parsed.path)}/{name}", "rb") as f:
                    self.open[name] = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
            else:
                fs, base = file_system(self.uri)
                with tempfile.TemporaryFile() as f, fs.open_input_stream(f"{base}/{name}", compression=None) as source:
                    while block := source.read(1 << 22):
                        f.write(block)
                    f.flush()
                    self.open[name] = mmap.mmap(f.fileno(), os.fstat(f.fileno()).st_size, access=mmap.ACCESS_READ)
        out, at = [], 0
        for kind, n in layout:
            out.append(np.frombuffer(self.open[name], kind, n, at))
            at += n * np.dtype(kind).itemsize
        return out


def _find(sorted_: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where found, index there) for sorted ``asked``."""
    at = np.minimum(np.searchsorted(sorted_, asked), len(sorted_) - 1)
    good = sorted_[at] == asked
    return np.flatnonzero(good), at[good]


def _by_shard(values: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    part = _shard(values, shards)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        yield int(s), order[cuts[s]: cuts[s + 1]]


def _take_off(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(count <= 0, 0.0, np.maximum(count - np.array((0.0, *d))[np.minimum(count, 3)], 0.0))


def _log_probabilities(model: Model, maps: _Maps, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 P(word | context) and the words' training counts."""
    own, back = np.unique(word, return_inverse=True)
    tokens, kinds = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
    for s, rows in _by_shard(own, model.shards):
        if s in model.words:
            path, n = model.words[s]
            names, c, k = maps.arrays(path, [(np.uint64, n), (np.int64, n), (np.int64, n)])
            got, at = _find(names, own[rows])
            tokens[rows[got]], kinds[rows[got]] = c[at], k[at]
    unknown = 1.0 / (model.types + 1)
    low = (_take_off(kinds, model.word_discounts) + model.word_rest * unknown) / model.kinds if model.kinds else np.full(len(own), unknown)

    first, of = np.unique(context, return_inverse=True)
    high, sums, rest = np.zeros(len(word)), np.zeros(len(first)), np.ones(len(first))
    d1, d2, d3 = model.discounts
    is_hot = _among(model.hot, first)
    total, n1, n2, n3 = model.hot_facts[np.searchsorted(model.hot, first[is_hot])].T
    sums[is_hot], rest[is_hot] = total, (d1 * n1 + d2 * n2 + d3 * n3) / total
    key = _pair_hash(context, word)
    for s, rows in _by_shard(np.where(is_hot[of], key, context), model.shards):
        if s not in model.pairs:
            continue
        path, n, m = model.pairs[s]
        keys, contexts, total, n1, n2, n3, count = maps.arrays(
            path, [(np.uint64, n), (np.uint64, m), (np.int64, m), (np.uint32, m), (np.uint32, m), (np.uint32, m), (np.uint32, n)])
        own = np.unique(of[rows])
        own = own[~is_hot[own]]
        got, at = _find(contexts, first[own])
        sums[own[got]] = total[at]
        rest[own[got]] = (d1 * n1[at] + d2 * n2[at] + d3 * n3[at]) / total[at]
        order = rows[np.argsort(key[rows])]
        found, where = _find(keys, key[order])
        here = order[found]
        high[here] = _take_off(count[where].astype(np.int64), model.discounts) / sums[of[here]]
    return np.log10(high + rest[of] * low[back]), tokens[back]


def score(docs: DataFrame, folder: str, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of whole texts (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])
    shipped = docs.sparkSession.sparkContext.broadcast(tuple(getattr(model, f) for f in Model.__dataclass_fields__))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, maps = Model(*shipped.value), _Maps(folder)
        for batch in batches:
            for piece in slices(batch, "text", SCORE_BYTES):
                context, word, bounds = _pairs(piece.column("text"))
                logs, counts = _log_probabilities(own, maps, context, word)
                base = np.log10((counts + 1.0) / (own.tokens + own.types + 1.0))
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (counts > 0, base, logs)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(np.diff(bounds)), pa.array(sums[0].astype(np.int64)),
                     pa.array(np.full(piece.num_rows, own.tokens, np.int64)), pa.array(sums[1]), pa.array(sums[2])], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
