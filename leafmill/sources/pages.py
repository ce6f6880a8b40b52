"""Page-text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.functions.text import file_stem

PAGE_SCHEMA = "doc_id string, page_idx bigint, text string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A page table on disk: ``doc_id, page_idx, text``."""
    return spark.read.parquet(path).select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("page_idx").cast("bigint").alias("page_idx"), "text")


def split_pages(docs: DataFrame, text: str = "text", doc: str = "doc_id",
                separator: str = "\f") -> DataFrame:
    """Paged document text -> page table; page numbers count every page, also empty ones."""
    pages = F.split(F.col(text), rf"\Q{separator}\E", -1)
    return docs.select(
        F.col(doc).cast("string").alias("doc_id"), F.posexplode(pages).alias("page_idx", "text")
    ).withColumn("page_idx", F.col("page_idx").cast("bigint"))


def read_paged_text(spark: SparkSession, path: str, separator: str = "\f") -> DataFrame:
    """Paged text files -> page table; large files are read in splits, a page at a time.

    The page separator is the record separator of the scan.  A page's number is its place
    in its split plus the pages of the file's earlier splits, counted in one row per split.
    """
    raw = spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("text"),
        F.monotonically_increasing_id().alias("row"))
    splits = raw.groupBy("file", "start").agg(
        F.min("row").alias("first_row"), F.count("*").alias("n"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.select(
        "file", "start", "first_row",
        F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint")).alias("before"))
    return raw.join(placed, ["file", "start"]).select(
        file_stem(F.col("file")).alias("doc_id"),
        (F.col("row") - F.col("first_row") + F.col("before")).alias("page_idx"), "text")
