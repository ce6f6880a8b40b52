"""Words and word shingles of whole Arrow batches as 64-bit hashes, with numpy.

A word is ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes, A-Z lower-cased.  Null and empty texts have
no words.  Work and memory follow the bytes of a slice of a few megabytes, not of the batch; a
single text longer than that is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20
SHORT = 48

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE = _TABLE[_FOLD]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = _U(0x9E3779B97F4A7C15)
_NEXT = _U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose texts hold about ``most`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
        if high > low:
            yield batch.slice(int(low), int(high - low))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]: bounds[-1]], bounds - bounds[0]


def words(texts: pa.Array, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Word hashes of all texts in order, and where each text's words begin (length n + 1).

    With ``prefixes``, a third array has the hashes of each word's first so many bytes (up to
    SHORT), 0 where a word is shorter.
    """
    raw, bounds = _bytes(texts)
    ink = ~_IS_SPACE[raw]
    before, after = np.empty_like(ink), np.empty_like(ink)
    if len(raw):
        before[0] = after[-1] = False
        before[1:], after[:-1] = ink[:-1], ink[1:]
        inner = bounds[(bounds > 0) & (bounds < len(raw))]
        before[inner] = False
        after[inner - 1] = False
    starts = np.flatnonzero(ink & ~before)
    lengths = np.flatnonzero(ink & ~after) + 1 - starts
    order = np.argsort(-np.minimum(lengths, SHORT + 1).astype(np.int8), kind="stable")
    first, size = starts[order], lengths[order]
    n_long = int(np.count_nonzero(size > SHORT))
    value = np.zeros(len(order), np.uint64)
    heads = np.zeros((len(order), len(prefixes)), np.uint64)
    alive = np.searchsorted(-size[n_long:], -np.arange(1, SHORT + 1), side="right") + n_long
    for j, until in enumerate(alive):
        if until == n_long:
            break
        piece = value[n_long:until]
        piece *= _BASE
        piece += _BYTE[raw[first[n_long:until] + j]]
        if j + 1 in prefixes:
            heads[order[n_long:until], prefixes.index(j + 1)] = mix(piece ^ _U(j + 1))
    for i in range(n_long):
        value[i] = xxhash.xxh64_intdigest(_FOLD[raw[first[i]: first[i] + size[i]]].tobytes())
    hashes = np.empty_like(value)
    hashes[order] = mix(value + size.astype(np.uint64) * _NEXT)
    begin = np.searchsorted(starts, bounds, side="left")
    return (hashes, begin, heads) if prefixes else (hashes, begin)


def shingles(hashes: np.ndarray, begin: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word shingles in order; a shorter text is one shingle as a whole.

    Returns the shingle hashes and where each text's shingles begin.
    """
    counts = np.diff(begin)
    made = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(made)))
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - begin[:-1], made)
    wide = np.repeat(np.minimum(counts, n), made)
    value = np.zeros(len(at), np.uint64)
    padded = np.concatenate((hashes, np.zeros(n, np.uint64)))
    for j in range(n):
        here = wide > j
        value = np.where(here, value * _NEXT + padded[at + j], value)
    return mix(value + wide.astype(np.uint64)), bounds


def strings(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.string())


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
