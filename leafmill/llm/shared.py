"""The shared folder, stage tables, and what several operators need.

Stage tables are Parquet in the folder named by ``spark.checkpoint.dir``: all executors can
read them, they cut lineage, and a lost executor costs only the tasks that read them.
"""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share.  A temporary one stands in on a local master only."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder as a worker reaches it, and the folder's path there."""
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table to the shared folder and go on from the written rows."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows over all tasks; used before steps whose work a row is large."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words of a text without building them: word starts are counted."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^ \\t-\\r]++")).cast("long")


def running_start(df: DataFrame, keys: list[str], chunk: str, size: str) -> DataFrame:
    """First offset of each chunk within its key: sums of all earlier chunks.

    One row per key and chunk enters the window; the chunks are counts, not rows.
    """
    sums = df.groupBy(*keys, chunk).agg(F.sum(size).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*keys, chunk, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))


HOT_KEYS = 1000


def join_hot(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """Join (inner or left) of ``rows`` with the stage table ``keyed``, one row a key, where ``weight`` is about how many rows have it.

    Keys of at least a HOT_KEYS-th of all weight, of which there are no more than HOT_KEYS, go to every task; the
    rows of the others are shuffled, so that no key brings a task a large share.
    """
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_KEYS >= total
    sent = F.broadcast(keyed.where(hot))
    return rows.join(sent, keys).unionByName(rows.join(sent, keys, "left_anti").join(keyed.where(~hot), keys, how))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components: ``links`` (a, b) longs, any order -> (node, component).

    Alternates large-star and small-star steps; every step writes at most one row per link, so
    a hub with many links adds none.  ``component`` is the smallest node of a component.
    """
    edges = stage(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    for _ in range(rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .where("a != b").distinct())
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .union(low.select("u", "m")).where("a != b").distinct())
        after = stage(small, "links")
        same = _sum_of(after) == _sum_of(edges)
        edges = after
        if same:
            break
    else:
        raise RuntimeError("components: more rounds needed")
    flat = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return flat.union(flat.select(F.col("component").alias("node"), "component").distinct())


def _sum_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(F.greatest("a", "b"), F.least("a", "b"))).alias("x")).first()
    return row["n"], row["x"]
