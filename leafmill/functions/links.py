"""Link discovery in HTML text: anchors in document order, matched by file name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.spec import LINK_FILE_PATTERN, LINK_LANGUAGE_SEGMENT

_HIDDEN = r"(?is)<!--.*?-->|<(script|style|textarea|title)\b[^>]*>.*?</\1\s*>"
_QUOTED = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"']++)"""
_ANCHOR = r"""(?is)<a(?=[\s/>])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_HREF = (r"(?is)\A(?:[\s/]*+(?!href[\s=])[^\s=>/]++(?:\s*+=\s*+" + _QUOTED + r")?+)*+"
         r"[\s/]*+href\s*+=\s*+(" + _QUOTED + ")")
# Character references that can stand in a link, the ampersand last.
_ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"), ("&#39;", "'"),
             ("&lt;", "<"), ("&gt;", ">"), ("&#38;", "&"), ("&amp;", "&"))


def _unquote(value: Column) -> Column:
    bare = F.regexp_replace(value, r"""(?s)\A["'](.*)["']\z""", "$1")
    for entity, char in _ENTITIES:
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return bare


def hrefs(html: Column) -> Column:
    """``href`` values of all anchors, in document order; comments and scripts are skipped."""
    visible = F.regexp_replace(html, _HIDDEN, "")
    anchors = F.regexp_extract_all(visible, F.lit(_ANCHOR), F.lit(1))
    found = F.transform(anchors, lambda a: F.regexp_extract(a, _HREF, 1))
    return F.transform(F.filter(found, lambda h: h != ""), _unquote)


def file_name(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)([^/]*)\z", 1)


def absolute_url(href: Column, page_url: Column) -> Column:
    """Absolute links stay; others follow the part of the page URL before the language."""
    base = F.substring_index(page_url, LINK_LANGUAGE_SEGMENT, 1)
    return F.when(href.startswith("http"), href).otherwise(F.concat(base, href))


def matching_links(html: Column, file_pattern: str = LINK_FILE_PATTERN) -> Column:
    """Links whose whole file name matches the pattern, any case, in document order."""
    return F.filter(hrefs(html), lambda h: file_name(h).rlike(rf"(?iU)\A(?:{file_pattern})\n?\z"))


def first_link(html: Column, file_pattern: str = LINK_FILE_PATTERN) -> Column:
    return F.get(matching_links(html, file_pattern), 0)
