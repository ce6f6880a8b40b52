"""Per-page operators: filters, ranges, and the extraction of everything printed on a page.

Nothing here shuffles, except the two operators that need a per-document size or rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import fields as fx
from leafmill.functions import sections as sx
from leafmill.functions.keys import is_parent_page, page_head, parent_key, parent_page_key
from leafmill.spec import DEFAULT_SPEC, FIRST_PAGES, PageSpec

# Positions of a document that are kept together in joins.
STRETCH = 65536



def non_empty(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("text") != "")


def parent_pages(pages: DataFrame, spec: PageSpec = DEFAULT_SPEC) -> DataFrame:
    """Non-empty pages with a key of their own (sub-entry pages and keyless pages go).

    The filter tests the text itself, so the key is extracted once, for kept pages only.
    """
    text = F.col("text")
    return pages.filter(is_parent_page(text, spec)).withColumn("frn", parent_page_key(text, spec))


def with_fields(pages: DataFrame, spec: PageSpec = DEFAULT_SPEC) -> DataFrame:
    """Add one nullable string column per labelled field, plus ``printed_key``.

    Each step is its own projection so that a value is computed once and then reused.
    """
    keep = pages.columns
    found = pages.withColumn("_lines", fx.label_lines(F.col("text"), spec))
    parts = found.select(
        *keep, F.transform("_lines", fx.line_label).alias("_printed"), F.transform("_lines", fx.line_value).alias("_given"))
    cut = parts.select(
        *keep,
        F.transform("_printed", fx.normal_label).alias("_labels"),
        F.transform("_given", lambda v: fx.cut_merged_lines(v, spec)).alias("_cut"),
    )
    clean = cut.select(
        *keep, "_labels", F.transform("_cut", lambda v: fx.clean_value(v, spec)).alias("_values"))
    picked = clean.select(
        *keep,
        fx.printed_key(F.col("text"), spec).alias("printed_key"),
        *[fx.pick(F.col("_labels"), F.col("_values"), label).alias(f"_{n}")
          for n, label in spec.fields],
        F.when(F.exists("_values", fx.is_indirect), fx.raw_notes(F.col("text"), spec)).alias("_notes"),
    )
    return picked.select(
        *keep, "printed_key",
        *[fx.follow_indirect(F.col(f"_{n}"), F.col("_notes"), n, spec).alias(n)
          for n in spec.field_names],
    )


def with_value(pages: DataFrame, name: str) -> DataFrame:
    """Rows whose extracted column ``name`` is not NULL.

    The test is on a generated column: a filter on the extracted one would be pushed through
    the projections of :func:`with_fields`, which then parse each page once for every time it names them.
    """
    tested = pages.select("*", F.explode_outer(F.array(F.col(name).isNotNull())).alias("_has"))
    return tested.filter(F.col("_has")).drop("_has")


def with_notes(pages: DataFrame, spec: PageSpec = DEFAULT_SPEC) -> DataFrame:
    text = F.col("text")
    cols = pages.columns
    return (
        pages.withColumn(
            "_section", sx.guarded(text, [spec.notes_header], sx.notes_section(text, spec)))
        .withColumn("_section", sx.declared_empty_to_null(F.col("_section"), spec))
        .withColumn("_notes", sx.parse_note_blocks(sx.note_blocks(F.col("_section"))))
        .select(*cols, sx.last_note_wins(F.col("_notes")).alias("notes"))
    )


def with_sub_entries(pages: DataFrame, spec: PageSpec = DEFAULT_SPEC) -> DataFrame:
    text = F.col("text")
    cols = pages.columns
    return (
        pages.withColumn(
            "_rows", sx.guarded(text, spec.table_open, sx.table_rows(text, spec)))
        .withColumn("_rows", sx.mark_table_rows(F.col("_rows")))
        .select(*cols, sx.parse_table_rows(F.col("_rows"), spec).alias("sub_entries"))
    )


def with_cross_references(pages: DataFrame, spec: PageSpec = DEFAULT_SPEC) -> DataFrame:
    text = F.col("text")
    return pages.withColumn(
        "cross_references",
        sx.guarded(text, [spec.xref_header], sx.cross_references(text, spec)))


def _parsed(pages: DataFrame, spec: PageSpec) -> DataFrame:
    return (
        pages.transform(with_fields, spec)
        .transform(with_notes, spec)
        .transform(with_sub_entries, spec)
        .transform(with_cross_references, spec)
    )


def page_extract(pages: DataFrame, spec: PageSpec = DEFAULT_SPEC) -> DataFrame:
    """``(doc_id, page_idx, text)`` -> one narrow row per parent page, no shuffle."""
    return _parsed(parent_pages(pages, spec), spec).select(
        "doc_id", "page_idx", "frn", "printed_key", *spec.field_names,
        "notes", "sub_entries", "cross_references")


def page_facts(pages: DataFrame, top_chars: int | None = None,
               spec: PageSpec = DEFAULT_SPEC) -> DataFrame:
    """Everything later steps need from page text, in one scan, one row per page.

    ``head_frn`` is the key of the page group; the other columns are those of
    :func:`page_extract` and NULL for pages that are no parent pages.
    """
    text = F.col("text")
    kept = pages.select(
        "doc_id", "page_idx", page_head(text, top_chars, spec).alias("_head"),
        F.when(is_parent_page(text, spec), text).alias("text"),
    ).select("doc_id", "page_idx", parent_key(F.col("_head"), spec).alias("head_frn"), "text",
             parent_page_key(text, spec).alias("frn"))
    return _parsed(kept, spec).select(
        "doc_id", "page_idx", "head_frn", "frn", "printed_key", *spec.field_names,
        "notes", "sub_entries", "cross_references")


def extracts_of(facts: DataFrame) -> DataFrame:
    """Parent pages of stored :func:`page_facts`."""
    return facts.filter(F.col("frn").isNotNull()).drop("head_frn")


def keyed_positions_of(facts: DataFrame) -> DataFrame:
    return facts.select("doc_id", "page_idx", F.col("head_frn").alias("frn"))


# ------------------------------------------------------------------ ranges
def page_range(pages: DataFrame, start: int, end: int, pos: str = "page_idx") -> DataFrame:
    """Half-open range of page indices; an upper bound past the end just ends there."""
    return pages.filter((F.col(pos) >= start) & (F.col(pos) < end))


def with_chunk(pages: DataFrame, chunks: int, doc: str = "doc_id", pos: str = "page_idx",
               total: int | None = None) -> DataFrame:
    """Number the ``chunks`` equal page ranges of every document.

    Without a known ``total`` the page counts are found per document.  They are joined back
    on document and stretch of positions, so that a document holding a large part of all
    pages is spread over many tasks; only one row per stretch is joined on the document.
    """
    columns = pages.columns
    if total is not None:
        sized = pages.withColumn("_total", F.lit(total).cast("bigint"))
    else:
        cut = pages.withColumn("_stretch", F.expr(f"`{pos}` DIV {STRETCH}"))
        ends = cut.groupBy(doc, "_stretch").agg(F.max(pos).alias("_end"))
        totals = ends.groupBy(doc).agg((F.max("_end") + 1).alias("_total"))
        parts = ends.select(F.col(doc).alias("_doc"), F.col("_stretch").alias("_part"))
        totals = totals.select(F.col(doc).alias("_total_doc"), "_total")
        parts = parts.join(totals, F.col("_doc").eqNullSafe(F.col("_total_doc")))
        sized = cut.join(parts, F.col(doc).eqNullSafe(F.col("_doc")) & F.col("_stretch").eqNullSafe(F.col("_part")))
    width = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("_total") / F.lit(chunks)))
    return sized.select(*columns, F.floor(F.col(pos) / width).alias("chunk"))


def first_pages(pages: DataFrame, n: int = FIRST_PAGES, doc: str = "doc_id",
                pos: str = "page_idx", dense: bool = True) -> DataFrame:
    """First ``n`` pages of every document.

    With dense indices this is a pushed-down filter.  Otherwise the rank is counted by
    stretches of positions: whole stretches in front of the limit stay as they are, and only the one
    that holds it is ranked, on document and position alone.  Pages without a position are never
    among the first; a NULL document is a document of its own.
    """
    if dense:
        return pages.filter(F.col(pos) < n)
    cut = pages.filter(F.col(pos).isNotNull()).withColumn("_stretch", F.expr(f"`{pos}` DIV {STRETCH}"))
    earlier = Window.partitionBy(doc).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    open_ = (
        cut.groupBy(doc, "_stretch").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .filter(F.col("_before") < n)
        .select(F.col(doc).alias("_doc"), F.col("_stretch").alias("_part"), "_n", "_before")
    )
    here = F.col(doc).eqNullSafe(F.col("_doc")) & (F.col("_stretch") == F.col("_part"))
    place = F.row_number().over(Window.partitionBy("_doc", "_part").orderBy(pos))
    last = (
        cut.select(doc, pos, "_stretch").join(open_.filter(F.col("_before") + F.col("_n") > n), here)
        .withColumn("_place", place + F.col("_before")).filter(F.col("_place") == n)
        .select(F.col("_doc").alias("_last_doc"), F.col("_part").alias("_last_part"), F.col(pos).alias("_last_pos"))
    )
    limits = open_.join(last, F.col("_doc").eqNullSafe(F.col("_last_doc")) & (F.col("_part") == F.col("_last_part")), "left")
    kept = cut.join(limits.select("_doc", "_part", "_last_pos"), here)
    return kept.filter(F.col("_last_pos").isNull() | (F.col(pos) <= F.col("_last_pos"))).select(*pages.columns)


def union_pages(*parts: DataFrame) -> DataFrame:
    """Page tables from several sources as one; columns a source lacks are NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def in_document_order(df: DataFrame, *order: str) -> DataFrame:
    """Document order for a sink: a range-partitioned sort."""
    return df.orderBy(*(order or ("doc_id", "page_idx")))


def text_lines(df: DataFrame, *keep: str) -> DataFrame:
    """One row per text line with its position."""
    return df.select(*keep, F.posexplode(F.split("text", "\n", -1)).alias("line_idx", "line"))
