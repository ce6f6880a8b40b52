"""What is printed on a page: the profile every operator reads its patterns from.

The constants in the first block are fixed values.  They describe the printed
layout of the input documents and the target relational schema, so they have to
be exactly these for results to be right.  Another document family is handled by
passing another :class:`PageSpec`.
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------- fixed values
KEY_LABEL = "Firearm Reference Number (FRN):"

FIELD_LABELS = (
    ("make", "Make"),
    ("model", "Model"),
    ("manufacturer", "Manufacturer"),
    ("level", "Level"),
    ("type", "Type"),
    ("action", "Action"),
    ("country", "Country of Manufacturer"),
    ("legal_classification", "Legal Classification"),
    ("serial_numbering", "Serial Numbering"),
    ("year_dates", "Year Dates"),
    ("importer", "Importer"),
)

NO_VALUE = "no data"
INDIRECT_VALUE = "see note"

# Words that point at a notes line for a field; other fields use their own name.
NOTE_KEYWORDS = (
    ("serial_numbering", ("serial", "numbering")),
    ("year_dates", ("year", "date")),
    ("country", ("country", "manufacturer")),
)

NOTES_HEADER = "Notes"
NOTES_END = ("Cross-References", "Also Known As", "Firearms Reference Table")
NOTES_EMPTY = ("no data", "n/a")
XREF_HEADER = "Cross-References"
XREF_END = ("Also Known As", "Firearms Reference Table")

TABLE_OPEN = ("Calibre", "Shots", "Barrel")
TABLE_CLOSE = ("Notes", "Cross-References", "Also Known", "Year Dates", "Importer")
CLASS_PREFIX = "CC"
CLASS_STOP = ("para.", "Non-Commercial", "Manufacturer")
CLASS_MAX_TOKENS = 6

HEAD_CHARS = 400
FIRST_PAGES = 1000
SHOWN_ERRORS = 20

# Characters the search text drops, and what a dash becomes.
SEARCH_DROPPED = "()[]{}.,;:/|!?@#$%^&*+=~`\"'<>"
SEARCH_DASH = "DSH"

TABLE_RECORD = "dbo_frn"
TABLE_SUB = "dbo_frnSubEntry"
TABLE_NOTE = "dbo_frnNote"
TABLE_XREF = "dbo_frnCrossReference"
TABLE_BLOB = "dbo_frnPdf"

# Columns the search text of each table is made from, in order.
SEARCH_COLUMNS = {
    TABLE_RECORD: ("frn", "make", "model", "manufacturer", "level", "type", "action",
                   "country", "legal_classification", "year_dates", "importer"),
    TABLE_SUB: ("frn", "sub_frn", "calibre", "shots", "barrel_length", "legal_classification"),
    TABLE_NOTE: ("note_value", "bullet_index"),
    TABLE_XREF: ("ref_frn", "description"),
}

# Columns that equality lookups go through, per table.
LOOKUP_COLUMNS = {
    TABLE_RECORD: ("make", "manufacturer", "type", "action", "country",
                   "legal_classification", "model"),
    TABLE_SUB: ("frn", "sub_frn", "calibre", "barrel_length", "legal_classification"),
    TABLE_NOTE: ("frn", "note_key"),
    TABLE_XREF: ("frn",),
    TABLE_BLOB: ("frn",),
}

LINK_FILE_PATTERN = r"frt-\d+\.pdf"
LINK_LANGUAGE_SEGMENT = "/en/"
# ----------------------------------------------------------- end fixed values


@dataclass(frozen=True)
class PageSpec:
    """One document family: labels, section markers and row rules."""

    key_label: str = KEY_LABEL
    fields: tuple[tuple[str, str], ...] = FIELD_LABELS
    note_keywords: tuple[tuple[str, tuple[str, ...]], ...] = NOTE_KEYWORDS
    notes_header: str = NOTES_HEADER
    notes_end: tuple[str, ...] = NOTES_END
    notes_empty: tuple[str, ...] = NOTES_EMPTY
    xref_header: str = XREF_HEADER
    xref_end: tuple[str, ...] = XREF_END
    table_open: tuple[str, ...] = TABLE_OPEN
    table_close: tuple[str, ...] = TABLE_CLOSE
    class_prefix: str = CLASS_PREFIX
    class_stop: tuple[str, ...] = CLASS_STOP
    class_max_tokens: int = CLASS_MAX_TOKENS
    no_value: str = NO_VALUE
    indirect_value: str = INDIRECT_VALUE
    head_chars: int = HEAD_CHARS

    @property
    def field_names(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.fields)

    def keywords(self, field: str) -> tuple[str, ...]:
        return dict(self.note_keywords).get(field, (field,))


DEFAULT_SPEC = PageSpec()
