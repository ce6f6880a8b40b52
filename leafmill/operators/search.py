"""Search over the ``fullText`` column: token index, all-terms, prefix and suffix search.

Postings stay one row per (token, row key).  A common token may stand in a large part of
all rows, so its posting list is never gathered into one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.search import forward_half, mirrored_half, tokens
from leafmill.functions.text import quote
from leafmill.spec import SEARCH_DASH, SEARCH_DROPPED

FORWARD, MIRRORED = "f", "m"


def _keys(key: str | list[str] | tuple[str, ...]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def postings(df: DataFrame, key: str | list[str] | tuple[str, ...], full_text: str = "fullText",
             mirrored: bool = True) -> DataFrame:
    """``(token, side, *key)``: distinct tokens per row, both reading directions.

    ``key`` is one column or several that identify a row together.
    """
    text = F.col(full_text)
    sides = [(FORWARD, forward_half(text))]
    if mirrored:
        sides.append((MIRRORED, mirrored_half(text)))
    entries = F.array(*[F.struct(F.lit(s).alias("side"), tokens(t).alias("tokens"))
                        for s, t in sides])
    # Outer generation: see the note on exploding computed arrays in normalize.
    return (
        df.select(*_keys(key), F.explode_outer(entries).alias("e"))
        .select(F.explode_outer("e.tokens").alias("token"), F.col("e.side").alias("side"), *_keys(key))
        .filter(F.col("token").isNotNull())
    )


def token_stats(posted: DataFrame, key: str) -> DataFrame:
    """Rows per token and side; partially counted before the shuffle."""
    return posted.groupBy("token", "side").agg(
        F.count("*").alias("n_rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def write_postings(posted: DataFrame, path: str, partitions: int | None = None) -> None:
    """Token order on disk, so a token lookup reads few row groups; hot tokens span files."""
    order = ["side", "token", *[c for c in posted.columns if c not in ("side", "token")]]
    ranged = (posted.repartitionByRange(partitions, *order) if partitions
              else posted.repartitionByRange(*order))
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def query_terms(query: str) -> list[str]:
    """Terms of a query under the same cleaning rule as the search text."""
    cleaned = query.replace("-", SEARCH_DASH).translate({ord(c): None for c in SEARCH_DROPPED})
    return sorted({t for t in cleaned.lower().replace("\n", " ").split(" ") if t})


def _quoted(term: str) -> str:
    return rf"(?:\A|[ \n]){quote([term])}"


def term_search(df: DataFrame, query: str, full_text: str = "fullText") -> DataFrame:
    """Rows holding every term of the query: a filter on the scan, no shuffle.

    A query without terms finds nothing.
    """
    terms = query_terms(query)
    if not terms:
        return df.filter(F.lit(False))
    every = "".join(rf"(?=.*?{_quoted(t)}(?:[ \n]|\z))" for t in terms)
    return df.filter(F.lower(forward_half(F.col(full_text))).rlike(rf"(?s)\A{every}"))


def _single_term(term: str) -> str:
    terms = query_terms(term)
    if len(terms) != 1:
        raise ValueError(f"one term expected, got {term!r}")
    return terms[0]


def prefix_search(df: DataFrame, prefix: str, full_text: str = "fullText") -> DataFrame:
    """Rows with a word starting with ``prefix``."""
    pattern = _quoted(_single_term(prefix))
    return df.filter(F.lower(forward_half(F.col(full_text))).rlike(pattern))


def suffix_search(df: DataFrame, suffix: str, full_text: str = "fullText") -> DataFrame:
    """Rows with a word ending in ``suffix``: a prefix search on the mirrored words."""
    pattern = _quoted(_single_term(suffix)[::-1])
    return df.filter(F.lower(mirrored_half(F.col(full_text))).rlike(pattern))


def term_lookup(posted: DataFrame, query: str, key: str | list[str] | tuple[str, ...]) -> DataFrame:
    """Row keys holding every term, from the stored postings: reads only the terms' rows.

    Distinct terms are counted, so it does not matter how many rows share a key.
    """
    terms = query_terms(query)
    hits = posted.filter((F.col("side") == FORWARD) & F.col("token").isin(terms)).select("token", *_keys(key)).distinct()
    found = hits.groupBy(*_keys(key)).agg(F.count("*").alias("_n"))
    return found.filter((F.col("_n") == len(terms)) & F.lit(bool(terms))).drop("_n")


def prefix_lookup(posted: DataFrame, prefix: str, key: str | list[str] | tuple[str, ...]) -> DataFrame:
    term = _single_term(prefix)
    return posted.filter(
        (F.col("side") == FORWARD) & F.col("token").startswith(term)).select(*_keys(key)).distinct()


def suffix_lookup(posted: DataFrame, suffix: str, key: str | list[str] | tuple[str, ...]) -> DataFrame:
    term = _single_term(suffix)[::-1]
    return posted.filter(
        (F.col("side") == MIRRORED) & F.col("token").startswith(term)).select(*_keys(key)).distinct()


def lookup(df: DataFrame, **equals: str) -> DataFrame:
    """Equality lookup on any columns; plain filters, so they reach the Parquet scan."""
    for column, value in equals.items():
        df = df.filter(F.col(column) == value)
    return df
