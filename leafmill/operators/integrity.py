"""Key and reference checks, load counts, and the short error report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.session import settle
from leafmill.spec import SHOWN_ERRORS, TABLE_RECORD


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, *key: str) -> None:
    """Fail as a plain insert into a table with this primary key would."""
    offending = duplicate_keys(df, *key).take(1)
    if offending:
        raise ValueError(f"duplicate key {offending[0].asDict()}")


def known_only(child: DataFrame, parent: DataFrame, child_key: str,
               parent_key: str | None = None) -> DataFrame:
    """Child rows whose key exists in the parent table."""
    return _match(child, parent, child_key, parent_key, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, child_key: str,
            parent_key: str | None = None) -> DataFrame:
    """Child rows whose key does not exist in the parent table."""
    return _match(child, parent, child_key, parent_key, "left_anti")


def _match(child, parent, child_key, parent_key, how) -> DataFrame:
    # A NULL or empty key is no reference to anything, and NULL never matches.  The key side
    # is made distinct before its shuffle, so a hot parent key is one row; Spark broadcasts
    # it only below its size threshold, and otherwise splits the child rows of a hot key.
    keys = parent.select(F.col(parent_key or child_key).alias("_key")).distinct()
    return child.join(keys, child[child_key] == keys["_key"], how)


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str,
                parent_key: str | None = None) -> DataFrame:
    """Missing parent keys with the number of child rows, counted before the join."""
    counted = child.groupBy(child_key).agg(F.count("*").alias("n_rows"))
    return _match(counted, parent, child_key, parent_key, "left_anti")


def referential_violations(tables: dict[str, DataFrame], key: str = "frn") -> DataFrame:
    """Missing parent keys of every child table (referenced keys elsewhere are free)."""
    parent = tables[TABLE_RECORD].select(key)
    parts = [
        orphan_keys(df, parent, key).select(F.lit(name).alias("table_name"), key, "n_rows")
        for name, df in tables.items() if name != TABLE_RECORD
    ]
    return reduce(DataFrame.unionByName, parts)


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts, one row per table."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def blob_report(blobs: DataFrame, parent: DataFrame, key: str = "frn") -> DataFrame:
    """Loaded, repeated and skipped blobs, counted per key first so that content is never shuffled.

    One blob of every known key is loaded, further ones are repeated; those of other keys are skipped.
    """
    counted = blobs.groupBy(key).agg(F.count("*").alias("n_rows"))
    keys = parent.select(F.col(key).alias("_key")).distinct()
    joined = counted.join(keys, counted[key] == keys["_key"], "left_outer")
    known = F.col("_key").isNotNull()
    return joined.agg(
        F.coalesce(F.sum(F.when(known, 1)), F.lit(0)).cast("bigint").alias("n_loaded"),
        F.coalesce(F.sum(F.when(known, F.col("n_rows") - 1)), F.lit(0)).cast("bigint").alias("n_repeated"),
        F.coalesce(F.sum(F.when(~known, F.col("n_rows"))), F.lit(0)).cast("bigint").alias("n_skipped"),
    )


def flow_report(facts: DataFrame, records: DataFrame, blobs: DataFrame | None = None, key: str = "frn") -> DataFrame:
    """``(measure, n)``: pages, records and blobs of a load, done and skipped.

    ``facts`` has one row per page, ``blobs`` the key of every file.
    """
    keyed = F.coalesce(F.col(key), F.lit("")) != ""
    totals = [
        facts.agg(F.count("*").alias("n")).select(F.lit("pages_processed").alias("measure"), "n"),
        records.filter(keyed).agg(F.count("*").alias("n")).select(F.lit("records_loaded").alias("measure"), "n"),
        records.filter(~keyed).agg(F.count("*").alias("n")).select(F.lit("records_skipped").alias("measure"), "n"),
    ]
    if blobs is not None:
        totals.append(blob_measures(blob_report(blobs, records.filter(keyed), key)))
    return reduce(DataFrame.unionByName, totals)


def blob_measures(counts: DataFrame) -> DataFrame:
    """:func:`blob_report` as ``(measure, n)``."""
    return counts.select(F.expr(
        "stack(3, 'blobs_loaded', n_loaded, 'blobs_repeated', n_repeated, 'blobs_skipped', n_skipped) AS (measure, n)"))


def first_errors(rejects: DataFrame, message: str, k: int = SHOWN_ERRORS) -> DataFrame:
    """The first ``k`` messages and, if there are more, a row with the remaining number."""
    found = settle(rejects.select(F.col(message).cast("string").alias("message")))
    shown = found.orderBy("message").limit(k)
    rest = found.agg((F.count("*") - k).alias("n")).filter("n > 0")
    return shown.select("message", F.lit(None).cast("bigint").alias("n_more")).unionByName(
        rest.select(F.lit("... and more").alias("message"), F.col("n").alias("n_more")))
