"""Binary files keyed by file name."""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import file_stem
from leafmill.operators.normalize import blob_rows
from leafmill.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TASK_BYTES = 128 << 20


def _scan(spark: SparkSession, folder: str, pattern: str, recursive: bool) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", str(recursive).lower()).load(folder))


def _packed(scan: DataFrame, size: int) -> DataFrame:
    """As many tasks as run at once or as ``size`` bytes ask for; Spark would give each a handful of small files."""
    return scan.coalesce(max(scan.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))


def _listing(spark: SparkSession, scan: DataFrame) -> DataFrame:
    """``(path, modificationTime, length)`` of every file, as a stage table.

    Spark's scan leaves out files without bytes.  They are those of its own listing that it has no row for, and get a row
    without a time; contents are not read.
    """
    seen = settle(_packed(scan.select("path", "modificationTime", "length"), 0), "files")
    # The listing names paths as URIs, the scan as plain text.
    listed = [(re.sub(r"\A([\w+.-]+:)///", r"\1/", unquote(uri)),) for uri in scan.inputFiles()]
    empty = spark.createDataFrame(listed, "path string").join(seen.select("path"), "path", "left_anti")
    return seen.unionByName(settle(empty.select(
        "path", F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(0).cast("bigint").alias("length")), "empty"))


def _contents(scan: DataFrame, listing: DataFrame) -> DataFrame:
    size = listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    columns = ["path", "modificationTime", "length", "content"]
    return _packed(scan.select(*columns), size).unionByName(
        listing.where("length = 0").withColumn("content", F.expr("X''")).select(*columns))


def read_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", recursive: bool = False) -> DataFrame:
    """``(path, modificationTime, length, content)`` of every file, empty ones too."""
    scan = _scan(spark, folder, pattern, recursive)
    return _contents(scan, _listing(spark, scan))


def read_blobs(spark: SparkSession, folder: str, pattern: str = "*.pdf", recursive: bool = False) -> DataFrame:
    """``(frn, pdf64)`` of every file."""
    scan = _scan(spark, folder, pattern, recursive)
    listing = _listing(spark, scan)
    return blob_rows(_contents(scan, listing), paths=listing)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", recursive: bool = False) -> DataFrame:
    """Files in path order with their key; contents are not read."""
    listing = _listing(spark, _scan(spark, folder, pattern, recursive))
    return listing.select("path", file_stem(F.col("path")).alias("frn"), "length").orderBy("path")


def _file_writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    uri = re.sub(r"\Afile:/+", "file:///", folder) if re.match(r"[\w+.-]+:", folder) else f"file://{folder}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(uri)
        made = set()
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content")):
                path = f"{base}/{name}"
                parent = path.rpartition("/")[0]
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                # Scans pass over names with a leading dot; a task that runs again replaces the file by its like.
                part = f"{parent}/.{uuid.uuid4().hex}"
                with store.open_output_stream(part, compression=None) as out:
                    out.write(content.as_buffer() if content.is_valid else b"")
                if store.get_file_info(path).type != pafs.FileType.NotFound:
                    store.delete_file(path)
                store.move(part, path)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return run


def write_files(files: DataFrame, folder: str) -> int:
    """Write ``(name, content)`` as one file each, null as an empty one, and count them.

    Tasks write their own rows; ``name`` may have folders.  All executors must reach ``folder``.
    """
    written = files.select("name", "content").mapInArrow(_file_writer(folder.rstrip("/")), "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
