"""String building blocks, all native Column expressions.

Regex conventions (Java dialect): ``(?U)`` for Unicode ``\\s``/``\\d``, ``(?d)`` so that
only ``\\n`` ends a line, ``\\z`` for the end of the input.  ``WS`` includes U+001C..U+001F,
which Java's Unicode ``\\s`` leaves out.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as character classes: the Latin-1 characters are listed one by one, which Java
# tests with one bitmap, and the property is asked only in the range of the others.
_WIDE_WS = r"[\u1680-\u3000&&\s]"
_LATIN_WS = r"\t\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
WS = rf"[\n{_LATIN_WS}{_WIDE_WS}]"
NOT_WS = rf"[^\n{_LATIN_WS}{_WIDE_WS}]"
LINE_WS = rf"[{_LATIN_WS}{_WIDE_WS}]"

# Every whitespace character, for trimming without a regex.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A digit character: decimal digits plus the superscript, subscript and enclosed
# digits that carry a digit value in the Unicode character database.
DIGIT = (
    r"[\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}"
    r"\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}"
    r"\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}]"
)


def quote(words) -> str:
    """Alternation of literal words, safe inside a Java pattern."""
    return "|".join(re.sub(r"([\\.^$|()\[\]{}*+?\-&])", r"\\\1", w) for w in words)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def collapse(c: Column) -> Column:
    """Runs of whitespace become one blank, ends are trimmed; a run that is one blank already is no match."""
    return F.trim(F.regexp_replace(c, rf"(?U){WS}(?:(?<! ){WS}*+|{WS}++)", " "))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, NULL instead of '' where nothing matched."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def contains_all(c: Column, words) -> Column:
    cond = F.lit(True)
    for word in words:
        cond = cond & c.contains(word)
    return cond


def null_if_no_value(c: Column, no_value: str) -> Column:
    """'' and the printed "no value" word, in any case, are absent values."""
    return F.when(~F.lower(c).isin("", no_value), c)


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def head(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def camel_case(c: Column, tidy: bool = False) -> Column:
    """'Serial Number' -> 'serialNumber'; ``tidy`` text has only inner blanks as whitespace."""
    words = c if tidy else collapse(c)
    first = F.substring_index(words, " ", 1)
    rest = F.substr(F.initcap(words), F.length(first) + 1)
    return F.concat(F.lower(first), F.replace(rest, F.lit(" "), F.lit("")))


def table_text(c: Column) -> Column:
    """Value as the tables hold it: never NULL."""
    return F.coalesce(c, F.lit(""))


def base64_text(content: Column) -> Column:
    """Standard alphabet on one line."""
    return F.translate(F.base64(content), "\r\n", "")


def file_stem(path: Column) -> Column:
    """Last path segment without its last extension.

    Leading dots belong to the stem ('.x' has no extension).
    """
    name = F.regexp_extract(path, r"([^/]*)\z", 1)
    return F.regexp_replace(name, r"(?s)\A(\.*[^.].*)\.[^.]*\z", "$1")
