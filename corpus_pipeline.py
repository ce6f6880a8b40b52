"""Corpus pipeline: language ID, line dedup, near-copy join, decontamination, mixing.

Each stage takes the documents its predecessor kept and, but for the last, returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import decontaminate, langid, lines, mixing, ngram_join
from leafmill.llm.shared import stage, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language go; equal rows fare alike."""
    key = F.xxhash64("doc_id", "text", "lang", "source")
    rows = langid.of_documents(docs).withColumn("_row", key)
    gone = langid.identify(rows, ["_row"]).where("rejected").select("_row").distinct()
    return docs.withColumn("_row", key).join(gone, "_row", "left_anti").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 code points and more that 5 documents hold stay only in the largest doc_id."""
    cleaned = lines.dedup_lines(docs)
    changed = cleaned.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by near copies, the one of the smallest doc_id stays; those without words stay."""
    gone = ngram_join.join_components(docs).where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs).taken


STAGES = [
    ("language ID", known_language),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.lower().replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
