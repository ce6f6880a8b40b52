"""Line dedup with sharded cuckoo filters over exact reference-count tables.

The index is a folder of stage tables.  ``entries`` is the exact table: one signed row per key,
document and batch, so that a later batch can take a document back.  ``counts`` nets it to the
number of documents that hold a key, and the largest of them.  ``filters`` has one cuckoo
filter per shard with the keys that at least ``min_docs`` documents hold: a row of a key that the filter
does not know is neither shuffled nor looked up in the exact table.  Deletion removes fingerprints again.  ``state``
names the tables that hold after each batch, so that ``LineIndex.open`` finds them in a later session.

A line's key is the line with white space stripped at both ends and A-Z lower-cased.  Keys of
fewer than ``min_chars`` code points are never dropped.  Keys are stored as two 64-bit hashes.

Defined results: a null or empty text is one empty line and stays; a null doc_id is the smallest
document; rows that repeat a doc_id are one document; lines that repeat in a document count once
and are all kept or all dropped; empty tables give empty results; other columns stay as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.shared import SPACE, ascii_lower, new_folder
from leafmill.llm.words import mix

MIN_CHARS, MIN_DOCS = 40, 5
KEYS_PER_SHARD = 250_000
FILTER_BYTES, SALTS = 64 << 20, 8
SLOTS = 4
_NO_DOC = -(1 << 63)


class CuckooFilter:
    """16-bit fingerprints in buckets of four, each in one of two places; works on arrays of keys."""

    def __init__(self, capacity: int, table: np.ndarray | None = None):
        wanted = max(2, int(capacity / (SLOTS * 0.85)) + 1)
        buckets = 1 << (wanted - 1).bit_length()
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys.view(np.uint64))
        print_ = (h >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1
        return print_, (h & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, print_: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        step = mix(print_.astype(np.uint64)) & np.uint64(len(self.table) - 1)
        return bucket ^ step.astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        print_, bucket = self._places(keys)
        other = self._other(print_, bucket)
        return ((self.table[bucket] == print_[:, None]).any(1) | (self.table[other] == print_[:, None]).any(1))

    def insert(self, keys: np.ndarray, rounds: int = 400) -> bool:
        """Insert distinct keys; False if the filter is too full, which leaves it unusable."""
        print_, bucket = self._places(keys)
        turn = np.random.Generator(np.random.PCG64(len(keys)))
        for _ in range(rounds):
            if not len(print_):
                return True
            order = np.argsort(bucket, kind="stable")
            print_, bucket = print_[order], bucket[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            free = self.table[bucket] == 0
            fits = rank < free.sum(1)
            slot = np.argmax(np.cumsum(free, 1) == (rank + 1)[:, None], 1)
            self.table[bucket[fits], slot[fits]] = print_[fits]
            kicks = ~fits & (rank == free.sum(1))
            at, into = bucket[kicks], turn.integers(0, SLOTS, int(kicks.sum()))
            moved = self.table[at, into]
            self.table[at, into] = print_[kicks]
            waits = ~fits & ~kicks
            print_ = np.concatenate((print_[waits], moved))
            bucket = np.concatenate((bucket[waits], at))
            bucket = self._other(print_, bucket)
        return not len(print_)

    def delete(self, keys: np.ndarray) -> None:
        """Take back distinct keys that were inserted before."""
        print_, bucket = self._places(keys)
        for _ in range(2):
            while len(print_):
                _, first = np.unique(bucket * 65536 + print_, return_index=True)
                hit = self.table[bucket[first]] == print_[first][:, None]
                found = hit.any(1)
                self.table[bucket[first][found], hit[found].argmax(1)] = 0
                left = np.ones(len(print_), bool)
                left[first[found]] = False
                stuck = not found.any()
                print_, bucket = print_[left], bucket[left]
                if stuck:
                    break
            bucket = self._other(print_, bucket)

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        capacity = len(keys)
        while True:
            made = cls(capacity)
            if made.insert(keys):
                return made
            capacity = 2 * capacity + 8

    def blob(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def read(cls, blob: bytes) -> CuckooFilter:
        return cls(0, np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(SPACE)))


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("k1"), F.xxhash64(key, F.lit("second")).alias("k2"))


def _doc(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id), F.lit(_NO_DOC)).cast("long")


def line_entries(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc): the long line keys of each document, once each."""
    return (
        docs.select(_doc().alias("doc"), F.explode(F.array_distinct(F.transform(lines_of(F.col("text")), line_key))).alias("key"))
        .where(F.length("key") >= min_chars)
        .select(_hashes(F.col("key")).alias("k"), "doc").select("k.k1", "k.k2", "doc").distinct()
    )


class LineIndex:
    """A growing and shrinking set of documents and the line keys they hold.

    All of it lies in ``folder``; ``open`` goes on from there, in any session.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS):
        self.spark, self.min_chars, self.min_docs = spark, min_chars, min_docs
        self.folder = folder or new_folder(spark, "line-index")
        self.batches: list[str] = []
        self.shards = 1
        self.version = 0
        self.counted: DataFrame | None = None
        self.filters: DataFrame | None = None

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> LineIndex:
        """The index that a folder holds, as its last batch left it."""
        state = spark.read.parquet(f"{folder}/state").orderBy(F.desc("version")).first()
        index = cls(spark, folder, state["min_chars"], state["min_docs"])
        index.batches, index.shards, index.version = list(state["batches"]), state["shards"], state["version"]
        index.counted = spark.read.parquet(f"{folder}/{state['counts']}")
        index.filters = spark.read.parquet(f"{folder}/{state['filters']}")
        return index

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add documents (doc_id, text); the exact table gets one row per key and document."""
        return self._append(line_entries(docs, self.min_chars).withColumn("sign", F.lit(1)))

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Take documents (doc_id) back as if they had never been inserted."""
        gone = doc_ids.select(_doc().alias("doc")).distinct()
        return self._append(self.entries().join(gone, "doc", "left_semi")
                            .select("k1", "k2", "doc", (-F.col("n")).cast("int").alias("sign")))

    def entries(self) -> DataFrame:
        """(k1, k2, doc, n): what each document holds after all batches."""
        log = self.spark.read.parquet(*(f"{self.folder}/{b}" for b in self.batches))
        if len(self.batches) == 1:
            return log.withColumnRenamed("sign", "n")
        return log.groupBy("k1", "k2", "doc").agg(F.sum("sign").cast("int").alias("n")).where("n > 0")

    def _written(self, rows: DataFrame, name: str) -> str:
        """A table of the folder; its name is new, so that a job that was broken off is in nobody's way."""
        path = f"{name}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{path}")
        return path

    def _append(self, rows: DataFrame) -> LineIndex:
        self.batches.append(self._written(rows, "entries"))
        before = self.counted
        counts = self._written(
            self.entries().groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc")), "counts")
        self.counted = self.spark.read.parquet(f"{self.folder}/{counts}")
        n_keys = self.counted.where(F.col("n_docs") >= self.min_docs).count()
        shards = max(1, -(-n_keys // KEYS_PER_SHARD))
        known = self.counted.where(F.col("n_docs") >= self.min_docs).select("k1", "k2")
        filters = None
        if self.filters is not None and shards <= self.shards:
            was = before.where(F.col("n_docs") >= self.min_docs).select("k1", "k2")
            change = (known.join(was, ["k1", "k2"], "left_anti").withColumn("add", F.lit(True))
                      .union(was.join(known, ["k1", "k2"], "left_anti").withColumn("add", F.lit(False))))
            filters = self._written(
                self.filters.groupBy("shard").cogroup(self._sharded(change).groupBy("shard"))
                .applyInArrow(_update, "shard int, filter binary"), "filters")
        if filters is None or not self.spark.read.parquet(f"{self.folder}/{filters}").where("filter is null").isEmpty():
            self.shards = shards
            filters = self._written(
                self._sharded(known).groupBy("shard").applyInArrow(_build, "shard int, filter binary"), "filters")
        self.filters = self.spark.read.schema("shard int, filter binary").parquet(f"{self.folder}/{filters}")
        self.version += 1
        state = [(self.version, self.batches, self.shards, counts, filters, self.min_chars, self.min_docs)]
        (self.spark.createDataFrame(state, "version int, batches array<string>, shards int, counts string, filters string, min_chars int, min_docs int")
         .coalesce(1).write.mode("append").parquet(f"{self.folder}/state"))
        return self

    def _sharded(self, keys: DataFrame) -> DataFrame:
        return keys.withColumn("shard", F.pmod(F.xxhash64("k1", F.lit("shard")), F.lit(self.shards)).cast("int"))

    def maybe_common(self, entries: DataFrame) -> DataFrame:
        """Those of ``entries`` (k1, k2, doc) whose key the filters know; never misses a common key.

        Filters of up to FILTER_BYTES in all go to every task and rows stay where they are; larger ones
        meet the rows of their shard, dealt to SALTS tasks each, in a sorted stream that holds one filter at a time.
        """
        size = self.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
        sharded = self._sharded(entries.select("k1", "k2", "doc"))
        if size <= FILTER_BYTES:
            known = {r["shard"]: r["filter"] for r in self.filters.collect()}
            shipped = self.spark.sparkContext.broadcast(known)
            return sharded.mapInArrow(_probe_sent(shipped), "k1 long, k2 long, doc long")
        none = [F.lit(None).cast("long").alias(c) for c in ("k1", "k2", "doc")]
        rows = sharded.select("shard", F.pmod(F.xxhash64("k2", "doc"), F.lit(SALTS)).cast("int").alias("salt"), F.lit(None).cast("binary").alias("filter"), "k1", "k2", "doc")
        led = self.filters.select("shard", F.explode(F.array(*(F.lit(k) for k in range(SALTS)))).alias("salt"), "filter", *none)
        return (rows.union(led).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("filter").isNull())
                .mapInArrow(_probe_met, "k1 long, k2 long, doc long"))

    def drops(self, entries: DataFrame) -> DataFrame:
        """(doc, keys): which keys each document of ``entries`` loses, as hashes.  Only what the filters know meets the exact table."""
        common = self.counted.where(F.col("n_docs") >= self.min_docs)
        return (
            self.maybe_common(entries).join(common, ["k1", "k2"]).where("doc < last_doc")
            .groupBy("doc").agg(F.collect_set(F.struct("k1", "k2")).alias("keys"))
        )

    def clean(self, docs: DataFrame, entries: DataFrame | None = None) -> DataFrame:
        """``docs`` with the kept lines as text, and n_lines and n_dropped."""
        drops = self.drops(line_entries(docs, self.min_chars) if entries is None else entries)
        drops = drops.select(F.col("doc").alias("_line_doc"), F.col("keys").alias("_line_drop"))
        joined = docs.withColumn("_line_id", _doc()).join(drops, F.col("_line_id") == F.col("_line_doc"), "left")
        lines = lines_of(F.col("text"))
        kept = F.when(F.col("_line_drop").isNull(), lines).otherwise(
            F.filter(lines, lambda x: ~F.array_contains(F.col("_line_drop"), _hashes(line_key(x)))
                     | (F.length(line_key(x)) < self.min_chars)))
        return (
            joined.withColumn("n_lines", F.size(lines).cast("long")).withColumn("_line_kept", kept)
            .withColumn("n_dropped", F.col("n_lines") - F.size("_line_kept"))
            .withColumn("text", F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(F.array_join("_line_kept", "\n")))
            .drop("_line_id", "_line_doc", "_line_drop", "_line_kept")
        )


def _keys(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    k1 = table.column("k1").to_numpy().astype(np.int64)
    k2 = table.column("k2").to_numpy().astype(np.int64)
    return k1.view(np.uint64) ^ mix(k2.view(np.uint64))


def _row(shard: int, made: CuckooFilter | None) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([made and made.blob()], pa.binary())})


def _build(table: pa.Table) -> pa.Table:
    return _row(table.column("shard")[0].as_py(), CuckooFilter.of(_keys(table)))


def _update(filters: pa.Table, change: pa.Table) -> pa.Table:
    shard = (filters if filters.num_rows else change).column("shard")[0].as_py()
    keys, add = _keys(change), change.column("add").to_numpy(zero_copy_only=False).astype(bool)
    if not filters.num_rows:
        return _row(shard, CuckooFilter.of(keys[add]))
    made = CuckooFilter.read(filters.column("filter")[0].as_py())
    made.delete(keys[~add])
    return _row(shard, made if made.insert(keys[add]) else None)  # too full: built anew from the exact table


def _known(batch: pa.RecordBatch, blobs: dict[int, CuckooFilter]) -> pa.RecordBatch:
    """Rows of the batch that the filter of their shard knows."""
    shard, keys = batch.column("shard").to_numpy(), _keys(batch)
    keep = np.zeros(len(keys), bool)
    for s in np.unique(shard).tolist():
        if s in blobs:
            own = shard == s
            keep[own] = blobs[s].contains(keys[own])
    return batch.select(["k1", "k2", "doc"]).filter(pa.array(keep))


def _probe_sent(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {shard: CuckooFilter.read(blob) for shard, blob in shipped.value.items()}
        for batch in batches:
            yield _known(batch, filters)

    return run


def _probe_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, CuckooFilter] = {}
    for batch in batches:
        lead = batch.column("filter").is_valid().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(lead)
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            if high > low:
                if lead[low]:
                    held = {batch.column("shard")[low].as_py(): CuckooFilter.read(batch.column("filter")[low].as_py())}
                yield _known(batch.slice(low + int(lead[low]), high - low - int(lead[low])), held)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All of ``docs`` through a new index: inserted, then cleaned; each common line stays in one document."""
    index = LineIndex(docs.sparkSession, min_chars=min_chars, min_docs=min_docs).insert(docs)
    return index.clean(docs, index.entries().drop("n"))
