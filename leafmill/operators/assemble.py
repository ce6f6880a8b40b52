"""Record assembly: many pages, one record per key (or per run of a key).

Every merge rule is a ``max_by``/``min_by`` over the page position, so pages are merged
in the task that read them before anything is shuffled, and a key that owns a large part
of all pages costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.operators.pages import page_extract
from leafmill.operators.runs import with_run_start
from leafmill.session import settle
from leafmill.spec import DEFAULT_SPEC, PageSpec

COLLECTIONS = ("notes", "sub_entries", "cross_references")


def last_present(name: str, pos: str = "page_idx") -> Column:
    """Value of the last page that has one."""
    return F.max_by(name, F.when(F.col(name).isNotNull(), F.col(pos))).alias(name)


def first_non_empty(name: str, pos: str = "page_idx") -> Column:
    """Collection of the first page where it is not empty; later ones are not appended."""
    return F.min_by(name, F.when(F.size(name) > 0, F.col(pos))).alias(name)


def _merge(extracts: DataFrame, group: list[str], spec: PageSpec) -> DataFrame:
    merged = extracts.groupBy(*group).agg(
        F.min("page_idx").alias("first_page_idx"),
        F.count("*").alias("n_pages"),
        *([] if "frn" in group else [F.min_by("frn", "page_idx").alias("frn")]),
        last_present("printed_key"),
        *[last_present(n) for n in spec.field_names],
        *[first_non_empty(n) for n in COLLECTIONS],
    )
    # The key line is a field as well: where a page prints it on a line of its own, the
    # last such line names the record.
    return merged.select(
        "doc_id", "first_page_idx", "n_pages",
        F.col("frn").alias("page_key"),
        F.coalesce("printed_key", "frn").alias("frn"),
        *spec.field_names, *COLLECTIONS,
    )


def assemble_global(extracts: DataFrame, spec: PageSpec = DEFAULT_SPEC) -> DataFrame:
    """One record per key and document, wherever its pages are."""
    return _merge(extracts, ["doc_id", "frn"], spec)


def assemble_runs(extracts: DataFrame, spec: PageSpec = DEFAULT_SPEC,
                  partitions: int | None = None, keyed: DataFrame | None = None, staged: bool = False) -> DataFrame:
    """One record per run of parent pages; a key that comes back later is a new record.

    Runs are found on document, position and key alone; the wide columns are shuffled once
    to meet their run, and after that only as partial aggregates.  ``keyed`` are these three
    columns of ``extracts``, where they are stored already; ``staged`` writes the joined columns as a stage table,
    so that the disk need not hold both shuffles at once.
    """
    narrow = extracts.select("doc_id", "page_idx", "frn") if keyed is None else keyed
    started = with_run_start(narrow, "frn", partitions=partitions).select(
        F.col("doc_id").alias("_doc"), F.col("page_idx").alias("_page"), "run_start")
    joined = extracts.join(
        started, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("page_idx") == F.col("_page"))).drop("_doc", "_page")
    return _merge(settle(joined, "run-pages") if staged else joined, ["doc_id", "run_start"], spec)


def assemble(extracts: DataFrame, mode: str = "global", spec: PageSpec = DEFAULT_SPEC, staged: bool = False) -> DataFrame:
    if mode not in ("global", "runs"):
        raise ValueError(f"unknown assembly mode {mode!r}")
    return assemble_global(extracts, spec) if mode == "global" else assemble_runs(extracts, spec, staged=staged)


def records(pages: DataFrame, mode: str = "global", spec: PageSpec = DEFAULT_SPEC) -> DataFrame:
    """Page table to records.

    For runs, the keys are read first and settled; everything else is extracted on the way to
    the join with the runs, so that only columns somebody asks for are parsed, and no wide stage table is written.
    """
    extracts = page_extract(pages, spec)
    if mode != "runs":
        return assemble(extracts, mode, spec)
    return assemble_runs(extracts, spec, keyed=settle(extracts.select("doc_id", "page_idx", "frn"), "run-keys"))
