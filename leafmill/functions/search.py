"""Search text: one normalised string per row holding its words forwards and mirrored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.spec import SEARCH_COLUMNS, SEARCH_DASH, SEARCH_DROPPED


_DROPPED = "[" + "".join("\\" + char for char in SEARCH_DROPPED) + "]+"


def clean_search_text(c: Column) -> Column:
    """Dashes become a word part, punctuation goes, end blanks go."""
    dashed = F.replace(c, F.lit("-"), F.lit(SEARCH_DASH))
    return F.trim(F.regexp_replace(dashed, _DROPPED, ""))


def mirrored(cleaned: Column) -> Column:
    """Cleaned text, a blank, and the cleaned text reversed; '' stays ''."""
    return F.trim(F.concat(cleaned, F.lit(" "), F.reverse(cleaned)))


def fulltextify(c: Column) -> Column:
    return mirrored(clean_search_text(c))


def with_full_text(df: DataFrame, table: str) -> DataFrame:
    """Add (or recompute) ``fullText`` from the current values of the table's search columns."""
    parts = [F.col(c).cast("string") for c in SEARCH_COLUMNS[table]]
    cleaned = df.withColumn("_clean", clean_search_text(F.concat_ws(" ", *parts)))
    return cleaned.withColumn("fullText", mirrored(F.col("_clean"))).drop("_clean")


def search_text_of(df: DataFrame, column: str) -> DataFrame:
    """Add ``fullText`` made from one column."""
    cleaned = df.withColumn("_clean", clean_search_text(F.col(column)))
    return cleaned.withColumn("fullText", mirrored(F.col("_clean"))).drop("_clean")


def _half(full_text: Column) -> Column:
    return F.floor(F.length(full_text) / 2).cast("int")


def forward_half(full_text: Column) -> Column:
    return F.substr(full_text, F.lit(1), _half(full_text))


def mirrored_half(full_text: Column) -> Column:
    return F.substr(full_text, _half(full_text) + 2)


def tokens(c: Column) -> Column:
    """Distinct lower-case tokens, split at blanks and line feeds."""
    words = F.array_distinct(F.split(F.lower(c), "[ \n]+"))
    return F.filter(words, lambda w: w != "")


def register_functions(spark: SparkSession) -> None:
    """Make ``fulltextify(s)`` callable from SQL, as a plain SQL expression."""
    dropped = _DROPPED.replace("\\", "\\\\").replace("'", "\\'")
    cleaned = f"trim(regexp_replace(replace(s, '-', '{SEARCH_DASH}'), '{dropped}', ''))"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION fulltextify(s STRING) RETURNS STRING RETURN "
        f"trim(concat({cleaned}, ' ', reverse({cleaned})))"
    )
