"""Expressions for the ``Label: value`` lines of a page.

A page is scanned once for all labels; the few label lines found are then cleaned as
arrays, so the cost of a page does not grow with the number of fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import WS, collapse, extract, lines, null_if_no_value, quote, strip
from leafmill.spec import DEFAULT_SPEC, PageSpec

# Letters that equal a plain letter when case is ignored, beyond upper and lower case.
_FOLDED_FROM, _FOLDED_TO = "\u017f\u212a\u0131\u0130", "skii"

# Marks a value that points at the notes; values never hold a line feed themselves.
_INDIRECT_MARK = "\n"


def _labels(spec: PageSpec) -> str:
    return quote(label for _, label in spec.fields)


def label_lines(text: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """All label lines of a page in order, any case: ``array<'Label:value'>``.

    A value may stand on a later line when nothing follows the label.  The zero-width
    match keeps a line that is both such a value and a label line itself.
    """
    pattern = rf"(?imdU)^(?=((?:{_labels(spec)}):{WS}*[^\n]+))"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def printed_key(text: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Key at the start of a line, any case: a field too, but not needed with the others."""
    return extract(text, rf"(?imdU)^{quote([spec.key_label])}{WS}*(\d+)")


def line_label(line: Column) -> Column:
    return F.substring_index(line, ":", 1)


def line_value(line: Column) -> Column:
    """'Label: value' -> the value stripped."""
    return strip(F.substr(line, F.instr(line, ":") + 1))


def normal_label(label: Column) -> Column:
    ascii_only = F.octet_length(label) == F.length(label)
    return F.lower(
        F.when(ascii_only, label).otherwise(F.translate(label, _FOLDED_FROM, _FOLDED_TO)))


def cut_merged_lines(value: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Drop what follows a second label that got printed on the same line."""
    merged = rf"(?isdU){WS}+(?:{_labels(spec)}){WS}*:.*\z"
    return F.when(value.contains(":"), strip(F.regexp_replace(value, merged, ""))).otherwise(value)


def is_label(value: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """The value is another field's label, so the field itself was empty."""
    return value.contains(":") & value.rlike(rf"(?iU)\A(?:{_labels(spec)}){WS}*:")


def clean_value(value: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Label-as-value rejected, whitespace collapsed, indirect values marked."""
    indirect = ((F.length(value) == len(spec.indirect_value))
                & (F.lower(value) == spec.indirect_value))
    return (
        F.when(is_label(value, spec), F.lit(None).cast("string"))
        .when(indirect, F.concat(F.lit(_INDIRECT_MARK), value))
        .otherwise(collapse(value))
    )


def is_indirect(value: Column) -> Column:
    return value.startswith(_INDIRECT_MARK)


def pick(labels: Column, values: Column, label: str) -> Column:
    """Value of the first line with the label."""
    return F.get(values, F.array_position(labels, label.lower()).cast("int") - 1)


def raw_notes(text: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Text after the notes header up to the first blank line, '' when there is none."""
    pattern = rf"(?isdU){quote([spec.notes_header])}{WS}*\n(.*?)(?:\n\n|\z)"
    return strip(F.regexp_extract(text, pattern, 1))


def note_lookup(notes: Column, field: str, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Value of the first notes line naming one of the field's keywords, NULL if none."""
    unusable = ["", spec.indirect_value, spec.no_value]

    def value_of(line: Column) -> Column:
        named = F.lit(False)
        for word in spec.keywords(field):
            named = named | F.lower(line).contains(word.lower())
        value = strip(F.substr(line, F.instr(line, ":") + 1))
        return F.when(named & ~F.lower(value).isin(unusable), value)

    found = F.filter(F.transform(lines(notes), value_of), lambda v: v.isNotNull())
    return F.get(found, 0)


def follow_indirect(value: Column, notes: Column, field: str, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """A value pointing at the notes is looked up there; without notes it stays as printed.

    Other values are kept unless they say that there is none.
    """
    return (
        F.when(~F.coalesce(is_indirect(value), F.lit(False)), null_if_no_value(value, spec.no_value))
        .when(notes != "", note_lookup(notes, field, spec))
        .otherwise(F.substr(value, F.lit(len(_INDIRECT_MARK) + 1)))
    )
