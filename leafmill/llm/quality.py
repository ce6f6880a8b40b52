"""Quality rules: heuristics of one text, and how many documents of a host hold each of its lines.

*Base rules* look at one text: a document fails with fewer than ``LEAST_WORDS`` words, or if more than
``REPEAT_PERCENT`` percent of its words lie in five-word windows that the text holds twice or more.

*Line frequency.*  A line is normalised (white space stripped at the ends and one space within, A-Z
lower-cased) and hashed to 64 bits.  Distinct documents are counted per host and line.  A line
is above the limits if more than ``LEAST_DOCS`` documents of its host hold it and also more than
``HOST_PERCENT`` percent of the host's documents.  Lines above the limits are removed, every occurrence; a
document of which fewer than ``LEAST_WORDS`` words or ``LEFT_PERCENT`` percent of its words are left is
depleted and rejected.

*At size.*  Texts are read in one scan that keeps only hashes and word counts of lines.  Rows per line
are summed before the shuffle; as a line has no more documents than rows, only lines of
enough rows have their documents counted exactly.  Joins with lines send the few of a known large share of all rows
to every task (``join_hot``) and shuffle the others, so that no key brings a task more than a thousandth of the rows.

Defined results: a null or empty text has no words, fails and is not kept; a null host is the host "";
all rows with a null doc_id are one document where documents are counted; rows that repeat a doc_id are
one document there and each have a verdict of their own; lines without a word are never counted nor removed;
empty tables give no rows; ``clean`` keeps other columns, the verdicts ignore them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.shared import join_hot, stage
from leafmill.llm.words import slices

WINDOW, LEAST_WORDS, REPEAT_PERCENT = 5, 10, 20
LEAST_DOCS, HOST_PERCENT, LEFT_PERCENT = 5, 1, 30
_SPACES, _INK = "[\\x20\\x09-\\x0D]+", "[^\\x20\\x09-\\x0D]"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MEASURED = ", ".join(f"{c} long" for c in ("_row", "doc_id")) + ", host string, " + ", ".join(f"{c} long" for c in _COUNTS)


def _parts(texts: pa.Array, split) -> tuple[pa.Array, np.ndarray]:
    """All parts of all texts, and the text that each is from."""
    lists = split(texts)
    return lists.flatten(), pc.list_parent_indices(lists).to_numpy().astype(np.int64)


def _ids(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Equal values have equal numbers; and the value of each number."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of pairs, equal for equal pairs."""
    return pd.factorize(a * (int(b.max(initial=0)) + 1) + b)[0].astype(np.int64)


def _repeat_words(row: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
    """Whether each word lies in a window of ``n`` words that its text holds twice or more."""
    covered = np.zeros(len(word), bool)
    if len(word) < n:
        return covered
    code = word
    for j in range(1, n):
        code = _pairs(code[:-1], word[j:])
    inside = row[n - 1:] == row[: len(code)]
    code = _pairs(row[: len(code)], code)
    twice = inside & (np.bincount(code[inside], minlength=int(code.max()) + 1)[code] >= 2)
    edges = np.zeros(len(word) + 1, np.int64)
    edges[:-1][: len(code)] += twice
    edges[n: n + len(code)] -= twice
    return np.cumsum(edges)[:-1] > 0


def _normalised(lines: pa.Array) -> pa.Array:
    return pc.ascii_trim(pc.replace_substring_regex(pc.ascii_lower(lines), _SPACES, " "), " ")


def _hashes(normalised: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x) for x in normalised.to_pylist()], np.uint64).view(np.int64)


def _split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return _parts(texts, lambda x: pc.split_pattern(x, "\n"))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            n, texts = piece.num_rows, pc.fill_null(piece.column("text"), "")
            words, row = _parts(texts, lambda x: pc.split_pattern_regex(x, _SPACES))
            solid = pc.greater(pc.binary_length(words), 0)
            words, row = words.filter(solid), row[solid.to_numpy(zero_copy_only=False)]
            chars = np.bincount(row, pc.utf8_length(words).to_numpy(zero_copy_only=False), n)
            repeated = np.bincount(row[_repeat_words(row, _ids(words)[0], WINDOW)], minlength=n)

            lines, of = _split_lines(texts)
            line, values = _ids(lines)
            normal = _normalised(values)
            inked = (pc.binary_length(normal).to_numpy(zero_copy_only=False) > 0)[line]
            line, of = line[inked], of[inked]
            distinct = pd.unique(of * max(len(values), 1) + line)
            dup_lines = np.bincount(of, minlength=n) - np.bincount(distinct // max(len(values), 1), minlength=n)

            # a document's distinct normalised lines in order, each with the words of all its occurrences
            hashes = _hashes(normal)
            sizes = pc.count_substring(normal, " ").to_numpy(zero_copy_only=False) + 1
            key, first = pd.factorize(hashes[line])
            code, pair = pd.factorize(of * max(len(first), 1) + key)
            total = np.bincount(code, sizes[line]).astype(np.int64) if len(code) else np.zeros(0, np.int64)
            bounds = np.concatenate(([0], np.cumsum(np.bincount(pair // max(len(first), 1), minlength=n)))).astype(np.int32)
            held = first[pair % max(len(first), 1)] if len(pair) else np.zeros(0, np.int64)

            counts = (np.bincount(row, minlength=n), chars, pc.count_substring_regex(texts, "[#*$%&|<>]").to_numpy(zero_copy_only=False),
                      dup_lines, repeated)
            yield pa.RecordBatch.from_arrays(
                [piece.column(c) for c in ("_row", "doc_id", "host")] + [pa.array(c.astype(np.int64)) for c in counts]
                + [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in (held, total)],
                ["_row", "doc_id", "host", *_COUNTS, "line", "line_words"])


def measure(rows: DataFrame) -> DataFrame:
    """Stage table of (_row, doc_id, host, text): counts of the text, and its distinct lines as hashes with their words."""
    rows = rows.select("_row", F.col("doc_id").cast("long"), F.coalesce(F.col("host").cast("string"), F.lit("")).alias("host"), "text")
    return stage(rows.mapInArrow(_measure, f"{_MEASURED}, line array<long>, line_words array<long>"), "quality-lines")


def _entries(measured: DataFrame) -> DataFrame:
    return (measured.select("_row", "doc_id", "host", F.explode(F.arrays_zip("line", "line_words")).alias("x"))
            .select("_row", "doc_id", "host", "x.line", F.col("x.line_words").alias("words")))


def frequent_lines(measured: DataFrame, least_docs: int = LEAST_DOCS, host_percent: float = HOST_PERCENT) -> DataFrame:
    """(host, line, n_rows, n_docs, host_docs) of lines above both limits, as a stage table."""
    entries = _entries(measured)
    candidates = stage(entries.groupBy("host", "line").agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > least_docs),
                       "quality-candidates")
    documents = (join_hot(entries.select("host", "line", "doc_id"), candidates, ["host", "line"], "n_rows").distinct()
                 .groupBy("host", "line").agg(F.count("*").alias("n_docs"), F.first("n_rows").alias("n_rows"))
                 .where(F.col("n_docs") > least_docs))
    hosts = stage(measured.select("host", "doc_id").distinct().groupBy("host").agg(F.count("*").alias("host_docs")), "quality-hosts")
    held = join_hot(stage(documents, "quality-documents"), hosts, ["host"], "host_docs")
    return stage(held.where(100 * F.col("n_docs") > host_percent * F.col("host_docs")), "quality-frequent")


def _base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def judge(measured: DataFrame, frequent: DataFrame, left_percent: float = LEFT_PERCENT) -> DataFrame:
    """Each measured row with base_failed, n_removed_words, removed (hashes of its lines above the limits, null if none) and kept."""
    hits = join_hot(_entries(measured).drop("doc_id"), frequent.select("host", "line", "n_rows"), ["host", "line"], "n_rows")
    lost = hits.groupBy("_row").agg(F.sum("words").alias("n_removed_words"), F.collect_list("line").alias("removed"))
    left = F.col("n_words") - F.col("n_removed_words")
    return (
        measured.drop("line", "line_words").join(lost, "_row", "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
        .withColumn("base_failed", _base_failed())
        .withColumn("kept", ~F.col("base_failed") & (left >= LEAST_WORDS) & (100 * left >= left_percent * F.col("n_words")))
    )


def quality(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, counts, base_failed, n_removed_words, kept) for each row of ``docs`` (doc_id, text, a host column)."""
    measured = measure(docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", F.col(host).alias("host"), "text"))
    return judge(measured, frequent_lines(measured)).drop("_row", "removed")


def clean(docs: DataFrame, host: str = "source") -> DataFrame:
    """The kept rows of ``docs`` with all their columns, their texts without lines above the limits."""
    rows = stage(docs.withColumn("_quality_row", F.monotonically_increasing_id()), "quality-documents")
    measured = measure(rows.select(F.col("_quality_row").alias("_row"), "doc_id", F.col(host).alias("host"), "text"))
    verdicts = judge(measured, frequent_lines(measured)).where("kept").select(F.col("_row").alias("_quality_row"), F.col("removed").alias("_quality_lost"))
    kept = rows.join(verdicts, "_quality_row")
    schema = docs.schema

    def drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, lost in enumerate(batch.column("_quality_lost").to_pylist()):
                if lost:
                    lines = pa.array(texts[i].split("\n"))
                    texts[i] = "\n".join(lines.filter(pa.array(~np.isin(_hashes(_normalised(lines)), lost))).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, batch.column("text").type) if f.name == "text" else batch.column(f.name) for f in schema], schema.names)

    return kept.drop("_quality_row").mapInArrow(drop_lines, schema)
