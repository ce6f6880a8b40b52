"""Nested records to relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.search import with_full_text
from leafmill.functions.text import base64_text, file_stem, table_text
from leafmill.operators.ids import with_row_id
from leafmill.operators.integrity import require_unique
from leafmill.session import settle
from leafmill.spec import (
    DEFAULT_SPEC, TABLE_BLOB, TABLE_NOTE, TABLE_RECORD, TABLE_SUB, TABLE_XREF, PageSpec,
)

# Columns that carry document order; kept on request only.
ORDER = ("doc_id", "first_page_idx")

# What a row of a table is numbered by.
TABLE_ORDER = {
    TABLE_SUB: (*ORDER, "pos"),
    TABLE_NOTE: (*ORDER, "pos", "bullet_index"),
    TABLE_XREF: (*ORDER, "pos"),
}


def keyed_records(records: DataFrame) -> DataFrame:
    """Records without a key are skipped."""
    return records.filter(F.coalesce(F.col("frn"), F.lit("")) != "")


def _explode(df: DataFrame, keep, column: str, pos: str, value: str) -> DataFrame:
    """Elements with their position; rows without elements emit nothing.

    Outer generation plus a filter on its result: for an inner one the optimizer would
    add size tests below, and compute an array that is not stored once per test.
    """
    out = df.select(*keep, F.posexplode_outer(column).alias(pos, value))
    return out.filter(F.col(pos).isNotNull())


def explode_sub_entries(records: DataFrame, *keep: str) -> DataFrame:
    out = _explode(keyed_records(records), (*keep, "frn"), "sub_entries", "pos", "e")
    return out.select(*keep, "frn", "pos", F.col("e.frn").alias("sub_frn"), "e.calibre", "e.shots",
                      "e.barrel_length", "e.legal_classification")


def explode_notes(records: DataFrame, *keep: str) -> DataFrame:
    """One row per bullet; ``bullet_index`` is its place under its note key."""
    notes = _explode(keyed_records(records), (*keep, "frn"), "notes", "pos", "n")
    return _explode(
        notes, (*keep, "frn", "pos", F.col("n.note_key").alias("note_key")),
        "n.bullets", "bullet_index", "note_value")


def explode_cross_references(records: DataFrame, *keep: str) -> DataFrame:
    out = _explode(keyed_records(records), (*keep, "frn"), "cross_references", "pos", "x")
    return out.select(*keep, "frn", "pos", F.col("x.frn").alias("ref_frn"), "x.description")


def _as_table(df: DataFrame, text_columns, other=(), keep=()) -> DataFrame:
    return df.select(*keep, *[table_text(F.col(c)).alias(c) for c in text_columns], *other)


def record_table(records: DataFrame, *keep: str, spec: PageSpec = DEFAULT_SPEC) -> DataFrame:
    flat = _as_table(keyed_records(records), ("frn", *spec.field_names), keep=keep)
    return with_full_text(flat, TABLE_RECORD)


def sub_entry_table(records: DataFrame, *keep: str) -> DataFrame:
    order = ("pos",) if keep else ()
    flat = _as_table(
        explode_sub_entries(records, *keep),
        ("frn", "sub_frn", "calibre", "shots", "barrel_length", "legal_classification"),
        keep=(*keep, *order))
    return with_full_text(flat, TABLE_SUB)


def note_table(records: DataFrame, *keep: str) -> DataFrame:
    order = ("pos",) if keep else ()
    flat = explode_notes(records, *keep).select(
        *keep, *order,
        table_text(F.col("frn")).alias("frn"), table_text(F.col("note_key")).alias("note_key"),
        F.coalesce("bullet_index", F.lit(0)).alias("bullet_index"),
        table_text(F.col("note_value")).alias("note_value"))
    return with_full_text(flat, TABLE_NOTE)


def cross_reference_table(records: DataFrame, *keep: str) -> DataFrame:
    order = ("pos",) if keep else ()
    flat = _as_table(
        explode_cross_references(records, *keep), ("frn", "ref_frn", "description"),
        keep=(*keep, *order))
    return with_full_text(flat, TABLE_XREF)


def blob_rows(files: DataFrame, known: DataFrame | None = None, paths: DataFrame | None = None) -> DataFrame:
    """``(path, content)`` -> ``(frn, pdf64)``: key from the file name, content as text.

    One blob per key, that of the lowest path.  With ``known`` keys other blobs are dropped.  Both
    is decided on path and key alone, before any content is moved or encoded; ``paths`` are those of
    ``files`` where they are known already.  Without ``known`` keys the join is with the further paths of
    keys that have several, so that contents stay where they are read while those are few.
    """
    named = (files if paths is None else paths).select(file_stem(F.col("path")).alias("frn"), "path")
    if known is not None:
        named = named.join(known.select("frn").distinct(), "frn", "left_semi")
    chosen = named.groupBy("frn").agg(F.min("path").alias("_first"))
    if known is not None:
        kept = files.select("path", "content").join(chosen.withColumnRenamed("_first", "path"), "path")
    else:
        # Settled, so that its size is known.  An anti join would be moved below the packing of small files into tasks.
        further = settle(named.join(chosen, "frn").where("path != _first").select("path").distinct(), "further")
        kept = (files.select("path", "content").where("path IS NOT NULL")
                .join(further.withColumn("_further", F.lit(True)), "path", "left").where("_further IS NULL")
                .withColumn("frn", file_stem(F.col("path"))))
    return kept.select("frn", base64_text(F.col("content")).alias("pdf64"))


def tables(records: DataFrame, blobs: DataFrame | None = None, *keep: str,
           spec: PageSpec = DEFAULT_SPEC, full_text: bool = True) -> dict[str, DataFrame]:
    """All tables by name; the blob table holds only blobs of known keys.  Without ``full_text`` their writer adds the search text."""
    out = {
        TABLE_RECORD: record_table(records, *keep, spec=spec),
        TABLE_SUB: sub_entry_table(records, *keep),
        TABLE_NOTE: note_table(records, *keep),
        TABLE_XREF: cross_reference_table(records, *keep),
    }
    if not full_text:
        out = {name: df.drop("fullText") for name, df in out.items()}
    if blobs is not None:
        out[TABLE_BLOB] = blob_rows(blobs, keyed_records(records))
    return out


def with_table_ids(made: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Give the child tables, made with their ``ORDER`` columns, dense ids in document order."""
    out = {}
    for name, df in made.items():
        if name in TABLE_ORDER:
            df = with_row_id(df, *TABLE_ORDER[name])
        out[name] = df.drop(*ORDER, "pos")
    return out


def upsert(current: DataFrame, changes: DataFrame, table: str, key: str = "frn") -> DataFrame:
    """Rows of ``changes`` replace rows of the same key; only their search text is computed anew.

    Fails if a key stands twice in ``changes``.
    """
    require_unique(changes, key)
    kept = current.join(changes.select(key), key, "left_anti")
    return kept.unionByName(with_full_text(changes.drop("fullText"), table), allowMissingColumns=True)
