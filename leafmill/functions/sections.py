"""Sections of a page: notes, the embedded table, and cross references.

Each parser works on the whole section string with a few linear regex passes and only
then turns the pieces into arrays of structs, so nothing is folded line by line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import (
    DIGIT, LINE_WS, NOT_WS, WS, camel_case, collapse, contains_all, quote, strip,
)
from leafmill.spec import DEFAULT_SPEC, PageSpec

NOTES_TYPE = "array<struct<note_key:string,bullets:array<string>>>"
SUB_TYPE = ("array<struct<frn:string,calibre:string,shots:string,barrel_length:string,"
            "legal_classification:string>>")
XREF_TYPE = "array<struct<frn:string,description:string>>"

# A line that opens a note: a capitalised heading, one or two dashes, a value.
_NOTE_HEAD = rf"[A-Z][A-Za-z ]{{1,49}}?{LINE_WS}*-{{1,2}}{LINE_WS}+"

# A table row: its key ``<digits> - <digits>``, then anything on the same line.
_TABLE_KEY = rf"{LINE_WS}*(\d+{LINE_WS}*-{LINE_WS}*\d+){LINE_WS}+"
_TABLE_ROW = rf"{_TABLE_KEY}[^\n]+"


def _section(text: Column, header: str, ends) -> Column:
    """From after the header line (any case) to the first end marker (exact case)."""
    return F.regexp_extract(
        text, rf"(?sdU)(?i:{quote([header])}){WS}*\n(.*?)(?:{quote(ends)}|\z)", 1)


def notes_section(text: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Notes text, its lines trimmed and none blank; '' when the page has no such section."""
    body = strip(_section(text, spec.notes_header, spec.notes_end))
    return F.regexp_replace(body, rf"(?U)(?<!{WS}){LINE_WS}*+\n{WS}*+", "\n")


def declared_empty_to_null(section: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    return F.when(~F.lower(section).isin("", *spec.notes_empty), section)


def note_blocks(section: Column) -> Column:
    """Section -> one string per note: heading line first, then its '- ' lines.

    Lines before the first heading are dropped; wrapped lines are joined to the line
    above with a blank.
    """
    from_first = F.regexp_extract(section, rf"(?smdU)^({_NOTE_HEAD}[^\n].*)\z", 1)
    unwrapped = F.regexp_replace(from_first, rf"(?dU)\n(?!- |{_NOTE_HEAD}[^\n])", " ")
    return F.regexp_extract_all(
        unwrapped, F.lit(r"(?md)^(?!- )[^\n]++(?:\n- [^\n]*+)*+"), F.lit(0))


def parse_note_blocks(blocks: Column) -> Column:
    """'Heading - a\\n- b' -> key 'heading', bullets a and b; one regex pass per note."""
    marks = rf"(?dU)\A([A-Z][A-Za-z ]{{1,49}}?){LINE_WS}*-{{1,2}}{LINE_WS}+|\n- {LINE_WS}*"
    parts = F.transform(blocks, lambda b: F.split(F.regexp_replace(b, marks, "$1\n"), "\n", -1))
    return F.transform(
        parts,
        lambda p: F.struct(
            camel_case(F.get(p, 0), tidy=True).alias("note_key"),
            F.slice(p, F.lit(2), F.size(p)).alias("bullets"),
        ),
    )


def last_note_wins(notes: Column) -> Column:
    """A repeated note key keeps its first position and takes its last value."""
    keys = F.array_distinct(F.transform(notes, lambda n: n["note_key"]))
    merged = F.transform(
        keys, lambda k: F.element_at(F.filter(notes, lambda n: n["note_key"] == k), -1))
    return F.when(F.size(keys) == F.size(notes), notes).otherwise(merged)


def table_rows(text: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Candidate rows of the embedded tables, as printed.

    A table body is the lines after an opening line, up to the next line that opens or
    closes one.
    """
    opens = "".join(rf"(?=[^\n]*{quote([w])})" for w in spec.table_open)
    closes = rf"[^\n]*(?:{quote(spec.table_close)})"
    table = rf"(?md)^{opens}[^\n]*+((?:\n(?!{opens}|{closes})[^\n]*+)*+)"
    bodies = F.array_join(F.regexp_extract_all(text, F.lit(table), F.lit(1)), "")
    return F.regexp_extract_all(bodies, F.lit(rf"(?mdU)^{_TABLE_ROW}"), F.lit(0))


def mark_table_rows(rows: Column) -> Column:
    """Rows as ``key \\n calibre \\n shots \\n barrel \\n rest``.

    Rows without two adjacent all-digit tokens are malformed and dropped.  The rightmost
    such pair is (shots, barrel length).
    """
    split_key = F.transform(
        rows, lambda r: F.split(F.regexp_replace(r, rf"(?dU)\A{_TABLE_KEY}", "$1\n"), "\n", 2))
    # the plain range in front of the digit class turns letters away before its many ranges are asked
    digits = rf"[0-9]++(?= |\z)|(?=[0-9\x{{b2}}-\x{{10ffff}}]){DIGIT}+"
    pair = rf"\A(?:(.*) )?({digits}) ({digits})(?: (.*))?\z"
    marked = F.transform(
        split_key,
        lambda k: F.concat(
            F.replace(F.get(k, 0), F.lit(" "), F.lit("")), F.lit("\n"),
            F.regexp_replace(collapse(F.get(k, 1)), pair, "$1\n$2\n$3\n$4")))
    return F.filter(
        F.transform(marked, lambda m: F.split(m, "\n", -1)), lambda p: F.size(p) == 5)


def parse_table_rows(parts: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Calibre stands left of the number pair, the classification right of it."""
    stop = rf"(?!(?:{quote(spec.class_stop)})(?: |\z))"
    cls = (rf"\A({quote([spec.class_prefix])}(?: {stop}[^ ]+){{0,{spec.class_max_tokens - 1}}}"
           rf"(?= |\z)|[^ ]+)")
    filled = F.transform(
        parts,
        lambda p: F.struct(
            F.get(p, 0).alias("frn"), F.get(p, 1).alias("calibre"), F.get(p, 2).alias("shots"),
            F.get(p, 3).alias("barrel_length"),
            F.regexp_extract(F.get(p, 4), cls, 1).alias("legal_classification"),
        ),
    )
    return F.transform(filled, lambda e: F.struct(*[
        (F.nullif(e[n], F.lit("")) if n in ("calibre", "legal_classification") else e[n]).alias(n)
        for n in ("frn", "calibre", "shots", "barrel_length", "legal_classification")]))


def cross_references(text: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Lines ``<digits> <text>`` of the cross-reference section, in order."""
    row = rf"{LINE_WS}*(\d+){LINE_WS}+([^\n]*{NOT_WS})"
    rows = F.regexp_extract_all(
        _section(text, spec.xref_header, spec.xref_end), F.lit(rf"(?mdU)^{row}"), F.lit(0))
    parts = F.transform(
        rows, lambda r: F.split(F.regexp_replace(r, rf"(?dU)\A{row}", "$1\n$2"), "\n", 2))
    return F.transform(
        parts, lambda p: F.struct(F.get(p, 0).alias("frn"), F.get(p, 1).alias("description")))


def guarded(text: Column, words, value: Column) -> Column:
    """Run a section parser only where the page has the section's words."""
    return F.when(contains_all(text, words), value)
