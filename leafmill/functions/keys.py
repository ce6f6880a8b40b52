"""Page keys: the key printed on a page, its parent, and the key in the page head."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import WS, extract, head, quote
from leafmill.spec import DEFAULT_SPEC, PageSpec


def _parent_pattern(spec: PageSpec) -> str:
    return rf"(?U){quote([spec.key_label])}{WS}*(\d+)"


def _sub_pattern(spec: PageSpec) -> str:
    return rf"{_parent_pattern(spec)}{WS}*-{WS}*(\d+)"


def page_key(text: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """``a-b`` where a sub-entry key stands anywhere on the page, else the first key, else NULL."""
    sub = _sub_pattern(spec)
    parent = extract(text, sub, 1)
    return F.when(
        text.contains(spec.key_label),
        F.coalesce(
            F.concat(parent, F.lit("-"), extract(text, sub, 2)),
            extract(text, _parent_pattern(spec), 1),
        ),
    )


def is_parent_page(text: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """The page has a key and no sub-entry key, tested without extracting it."""
    return (text.contains(spec.key_label) & text.rlike(_parent_pattern(spec))
            & ~text.rlike(_sub_pattern(spec)))


def parent_page_key(text: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Key of a page that passed :func:`is_parent_page`: no sub-entry key to look for."""
    return extract(text, _parent_pattern(spec))


def is_sub_entry(key: Column) -> Column:
    return F.coalesce(key.contains("-"), F.lit(False))


def parent_key(text: Column, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Key of the page group: sub-entry keys reduce to their parent."""
    return F.when(
        text.contains(spec.key_label),
        F.coalesce(extract(text, _sub_pattern(spec), 1), extract(text, _parent_pattern(spec), 1)),
    )


def page_head(text: Column, top_chars: int | None = None, spec: PageSpec = DEFAULT_SPEC) -> Column:
    return head(text, spec.head_chars if top_chars is None else top_chars)


def head_key(text: Column, top_chars: int | None = None, spec: PageSpec = DEFAULT_SPEC) -> Column:
    """Parent key searched only in the first ``top_chars`` characters of the page.

    Over many pages, take :func:`parent_key` of a column with the :func:`page_head`: here every pattern cuts it anew.
    """
    return parent_key(page_head(text, top_chars, spec), spec)
