"""Run detection: consecutive pages with the same key, per document.

A window over a whole document would put a huge document into one task.  Here document,
position and key are sorted by ranges, whatever the documents are, and runs are found inside
each range.  One row per range says how the range begins and ends; a running scan over those rows
alone tells which range goes on with the run before it, and where that run began.  There is one
level of this for any number and size of positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.session import settle

NO_KEY = ""


def _known(key: str) -> Column:
    """Keys as compared here: NULL is NO_KEY, and no key, '' included, equals it."""
    return F.when(F.col(key).isNull(), NO_KEY).otherwise(F.concat(F.lit("k"), F.col(key).cast("string")))


def _own(doc: str, key: str) -> Column:
    """What neighbours of a run have in common."""
    return F.struct(F.col(doc).alias("doc"), _known(key).alias("key"))


def _local_runs(df: DataFrame, key: str, doc: str, pos: str, partitions: int | None) -> DataFrame:
    """Stage table of the rows with their range ``_block``, the number ``_no`` of their run in it and where that run begins there."""
    ranged = df.repartitionByRange(partitions, doc, pos) if partitions else df.repartitionByRange(doc, pos)
    placed = ranged.sortWithinPartitions(doc, pos).withColumn("_mid", F.monotonically_increasing_id())
    placed = placed.withColumn("_block", F.shiftright("_mid", 33).cast("int"))
    inside = Window.partitionBy("_block").orderBy("_mid")
    changed = placed.withColumn("_own", _own(doc, key)).withColumn("_before", F.lag("_own").over(inside))
    changed = changed.withColumn("_new", F.col("_before").isNull() | ~F.col("_own").eqNullSafe(F.col("_before")))
    return settle(
        changed.withColumn("_no", F.sum(F.col("_new").cast("int")).over(inside))
        .withColumn("_begin", F.last(F.when(F.col("_new"), F.struct(F.col(pos).alias("pos"))), ignorenulls=True).over(inside))
        .drop("_own", "_before", "_new"), "run-ranges")


def _carried(local: DataFrame, key: str, doc: str) -> DataFrame:
    """(_block, _goes_on, _since): whether a range's first run began before it, and where; one row a range."""
    ends = local.withColumn("_own", _own(doc, key)).groupBy("_block").agg(
        F.min_by("_own", "_mid").alias("first"), F.max_by("_own", "_mid").alias("last"),
        F.max("_no").alias("n_runs"), F.max_by("_begin", "_mid").alias("begin"))
    order = Window.orderBy("_block")
    met = ends.withColumn("before", F.lag("last").over(order)).withColumn(
        "_goes_on", F.col("before").isNotNull() & F.col("first").eqNullSafe(F.col("before")))
    # the run that is open at a range's end began in it, unless all of the range is the run before
    begun = F.when(~(F.col("_goes_on") & (F.col("n_runs") == 1)), F.col("begin"))
    opened = met.withColumn("open", F.last(begun, ignorenulls=True).over(order))
    return opened.select("_block", "_goes_on", F.lag("open").over(order).alias("_since"))


def with_run_start(df: DataFrame, key: str, doc: str = "doc_id", pos: str = "page_idx",
                   partitions: int | None = None) -> DataFrame:
    """Add ``run_start``, the position of the first row of the row's run.

    NULL keys end a run and belong to none (``run_start`` is NULL).  To let such rows be
    passed over instead, filter them out first.  Positions are unique within a document.
    Rows of a NULL document are a document of their own; a NULL position comes first, and is the
    start of the run it begins.  All columns are sorted, so pass narrow rows; ``partitions`` is the
    number of ranges, by default what their size asks for.
    """
    local = _local_runs(df, key, doc, pos, partitions)
    # one row per range: a side of proven size
    joined = local.join(F.broadcast(_carried(local, key, doc)), "_block")
    start = F.when((F.col("_no") == 1) & F.col("_goes_on"), F.col("_since.pos")).otherwise(F.col("_begin.pos"))
    return joined.select(*df.columns, F.when(F.col(key).isNotNull(), start).alias("run_start"))


def runs(df: DataFrame, key: str, doc: str = "doc_id", pos: str = "page_idx", partitions: int | None = None) -> DataFrame:
    """One row per run: key, first and last position, number of rows."""
    narrow = df.select(doc, pos, key)
    return (
        with_run_start(narrow, key, doc, pos, partitions)
        .filter(F.col(key).isNotNull())
        .groupBy(doc, "run_start")
        .agg(F.min(key).alias(key), F.max(pos).alias("run_end"), F.count("*").alias("n_pages"))
    )
