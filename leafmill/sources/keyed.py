"""Tables that are changed row by key: merges that rewrite the files of touched keys only, and postings that keep in step.

Both keep Parquet files that are never changed, and a table of versions, one row each, that names the files which
are valid.  A merge writes new files first and appends its version last: a reader sees the old version or the new
one, and a job that was broken off leaves files that no version names.  One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafmill.functions.search import with_full_text
from leafmill.operators.integrity import require_unique
from leafmill.operators.search import postings, write_postings
from leafmill.session import settle

BUCKET = "keyed_bucket"
ROWS_PER_BUCKET = 1_000_000
_TABLE_STATE = "version int, keys array<string>, buckets int, schema string, parts map<int,array<string>>"
_INDEX_STATE = "version int, keys array<string>, base string, born int, parts array<struct<path:string,version:int>>, gone array<struct<path:string,version:int>>"


def _last_version(spark: SparkSession, folder: str, version: int | None):
    states = spark.read.parquet(f"{folder}/versions")
    if version is not None:
        states = states.where(F.col("version") == version)
    return states.orderBy(F.desc("version")).first()


def _require_keys(rows: DataFrame, keys: Sequence[str]) -> None:
    if rows.where(" OR ".join(f"`{c}` IS NULL" for c in keys)).take(1):
        raise ValueError(f"null in a key of {list(keys)}")
    require_unique(rows, *keys)


def _commit(spark: SparkSession, folder: str, state: tuple, schema: str) -> None:
    spark.createDataFrame([state], schema).coalesce(1).write.mode("append").parquet(f"{folder}/versions")


class KeyedTable:
    """A table whose rows are named by one or several columns together, without nulls.

    Rows lie in buckets by a hash of the whole key, so that no key of a parent, however many rows it has, fills one.
    A merge reads and rewrites the buckets of its keys, and leaves the files of all others as they are; an append adds files.
    """

    def __init__(self, spark: SparkSession, folder: str, state):
        self.spark, self.folder = spark, folder
        self.version, self.keys, self.buckets = state["version"], list(state["keys"]), state["buckets"]
        self.schema = StructType.fromJson(json.loads(state["schema"]))
        self.parts = {b: list(paths) for b, paths in state["parts"].items()}

    @classmethod
    def create(cls, spark: SparkSession, folder: str, rows: DataFrame, keys: Sequence[str], buckets: int | None = None) -> KeyedTable:
        """Write ``rows``; fails if a key stands twice or has a null."""
        _require_keys(rows, keys)
        buckets = buckets or max(1, -(-rows.count() // ROWS_PER_BUCKET))
        table = cls(spark, folder, {"version": -1, "keys": list(keys), "buckets": buckets, "schema": rows.schema.json(), "parts": {}})
        return table._put(rows, ())

    @classmethod
    def open(cls, spark: SparkSession, folder: str, version: int | None = None) -> KeyedTable:
        """The last version, or an earlier one."""
        return cls(spark, folder, _last_version(spark, folder, version))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, buckets=None) -> DataFrame:
        paths = [f"{self.folder}/{p}" for b, own in sorted(self.parts.items()) if buckets is None or b in buckets for p in own]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rows(self) -> DataFrame:
        return self._read()

    def _buckets_of(self, keys: DataFrame) -> set[int]:
        return {r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()}

    def _put(self, rows: DataFrame, touched) -> KeyedTable:
        """Write ``rows`` as the whole content of the touched buckets and as more of the others, and commit."""
        path = f"data/{uuid.uuid4().hex}"
        (rows.withColumn(BUCKET, self._bucket()).repartition(BUCKET).sortWithinPartitions(BUCKET, *self.keys)
         .write.partitionBy(BUCKET).parquet(f"{self.folder}/{path}"))
        written = self.spark.read.schema(f"{BUCKET} int").parquet(f"{self.folder}/{path}").distinct().collect()
        parts = {b: p for b, p in self.parts.items() if b not in touched}
        for (b,) in written:
            parts[b] = [*parts.get(b, ()), f"{path}/{BUCKET}={b}"]
        state = (self.version + 1, self.keys, self.buckets, self.schema.json(), parts)
        _commit(self.spark, self.folder, state, _TABLE_STATE)
        return KeyedTable(self.spark, self.folder, dict(zip(("version", "keys", "buckets", "schema", "parts"), state)))

    def _typed(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return df.select(*[F.col(c).cast(self.schema[c].dataType).alias(c) for c in columns])

    def merge(self, changes: DataFrame | None = None, deleted: DataFrame | None = None, text_of: str | None = None) -> KeyedTable:
        """``changes`` replace rows of their keys or are new; rows of the keys in ``deleted`` go, but for those in ``changes``.

        With ``text_of``, a table's name, the search text of ``changes``, and of no other row, is computed.
        """
        none = self.spark.createDataFrame([], self.schema)
        changes = none if changes is None else changes
        if text_of:
            changes = with_full_text(changes.drop("fullText"), text_of)
        changes = self._typed(changes, self.schema.names)
        _require_keys(changes, self.keys)
        asked = changes.select(*self.keys)
        if deleted is not None:
            asked = asked.union(self._typed(deleted, self.keys)).distinct()
        touched = self._buckets_of(asked)
        if not touched:
            return self
        kept = self._read(touched).join(asked, self.keys, "left_anti").select(*self.schema.names)
        return self._put(kept.union(changes), touched)

    def append(self, rows: DataFrame) -> KeyedTable:
        """Add rows of new keys; fails, with nothing written, if one of their keys is stored already.

        Files of the table stay, the rows get files of their own.  Only key columns are read, of the buckets that the new keys
        fall into, and of their row groups those between the least and the greatest new key.
        """
        rows = self._typed(rows, self.schema.names)
        _require_keys(rows, self.keys)
        touched = self._buckets_of(rows)
        if not touched:
            return self
        clash = self._near(rows, touched).join(rows.select(*self.keys), self.keys, "left_semi").take(1)
        if clash:
            raise ValueError(f"duplicate key {clash[0].asDict()}")
        return self._put(rows, ())

    def _near(self, rows: DataFrame, buckets) -> DataFrame:
        """Keys stored in the buckets, each column between the least and the greatest value in ``rows``."""
        ends = rows.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(self.keys) for n, f in (("low", F.min), ("high", F.max))]).first()
        stored = self._read(buckets).select(*self.keys)
        for i, c in enumerate(self.keys):
            stored = stored.where(F.col(c).between(F.lit(ends[f"low_{i}"]), F.lit(ends[f"high_{i}"])))
        return stored

    def replace(self, rows: DataFrame, by: Sequence[str]) -> KeyedTable:
        """``rows`` take the place of all stored rows of their parents, which the key columns ``by`` name.

        Buckets without rows of these parents, old or new, keep their files.
        """
        parents = rows.select(*by).distinct()
        old = settle(self._read().select(*self.keys).join(parents, list(by), "left_semi").select(*self.keys), "replaced")
        return self.merge(rows, old)


class PostingIndex:
    """Postings of a table's search text that follow its changes.

    Each change adds the postings of its rows, and the keys it touched as tombstones: postings older than the last tombstone
    of their key are dead.  ``compact`` writes the living ones as a new base.  ``live`` takes the place of stored postings in every
    lookup; filters on tokens reach the scans of all parts.
    """

    def __init__(self, spark: SparkSession, folder: str, state):
        self.spark, self.folder = spark, folder
        self.version, self.keys, self.base, self.born = state["version"], list(state["keys"]), state["base"], state["born"]
        self.parts, self.gone = [tuple(p) for p in state["parts"]], [tuple(p) for p in state["gone"]]

    @classmethod
    def create(cls, spark: SparkSession, folder: str, rows: DataFrame, keys: Sequence[str]) -> PostingIndex:
        """Postings of ``rows`` (keys, fullText)."""
        base = f"data/{uuid.uuid4().hex}"
        write_postings(postings(rows, list(keys)), f"{folder}/{base}")
        return cls._committed(spark, folder, (0, list(keys), base, 0, [], []))

    @classmethod
    def open(cls, spark: SparkSession, folder: str, version: int | None = None) -> PostingIndex:
        return cls(spark, folder, _last_version(spark, folder, version))

    @classmethod
    def _committed(cls, spark: SparkSession, folder: str, state: tuple) -> PostingIndex:
        _commit(spark, folder, state, _INDEX_STATE)
        return cls(spark, folder, dict(zip(("version", "keys", "base", "born", "parts", "gone"), state)))

    def _write(self, df: DataFrame) -> str:
        path = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{path}")
        return path

    def apply(self, changes: DataFrame | None = None, deleted: DataFrame | None = None) -> PostingIndex:
        """Follow a merge: ``changes`` (keys, fullText) are the rows as they are now, ``deleted`` (keys) are gone."""
        version, parts = self.version + 1, list(self.parts)
        touched = [df.select(*self.keys) for df in (changes, deleted) if df is not None]
        if not touched:
            return self
        if changes is not None:
            path = f"data/{uuid.uuid4().hex}"
            write_postings(postings(changes, self.keys), f"{self.folder}/{path}")
            parts.append((path, version))
        asked = (touched[0] if len(touched) == 1 else touched[0].union(touched[1])).distinct()
        gone = [*self.gone, (self._write(asked), version)]
        return self._committed(self.spark, self.folder, (version, self.keys, self.base, self.born, parts, gone))

    def live(self) -> DataFrame:
        """``(token, side, *keys)`` of the rows as they are now."""
        columns = ["token", "side", *self.keys]

        def read(path: str, version: int) -> DataFrame:
            return self.spark.read.parquet(f"{self.folder}/{path}").select(*columns, F.lit(version).alias("_born"))

        posted = read(self.base, self.born)
        for path, version in self.parts:
            posted = posted.union(read(path, version))
        if not self.gone:
            return posted.select(*columns)
        dead = None
        for path, version in self.gone:
            own = self.spark.read.parquet(f"{self.folder}/{path}").select(*self.keys, F.lit(version).alias("_dead"))
            dead = own if dead is None else dead.union(own)
        dead = dead.groupBy(*self.keys).agg(F.max("_dead").alias("_dead"))
        return posted.join(dead, self.keys, "left").where("_dead IS NULL OR _born >= _dead").select(*columns)

    def compact(self) -> PostingIndex:
        """One base of the living postings, without tombstones."""
        base, version = f"data/{uuid.uuid4().hex}", self.version + 1
        write_postings(self.live(), f"{self.folder}/{base}")
        return self._committed(self.spark, self.folder, (version, self.keys, base, version, [], []))
