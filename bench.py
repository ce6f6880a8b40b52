"""Headline timings; prints one JSON line.

``queries``: each registered headline query from the given tables to its full result.
``stages``: the engine alone on a stored page table printed from the order tables, with
pages per second; printing the pages is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from leafmill.functions.search import search_text_of
from leafmill.operators.assemble import records
from leafmill.operators.integrity import load_report
from leafmill.operators.manifest import page_manifest
from leafmill.operators.normalize import tables
from leafmill.operators.pages import page_extract
from leafmill.operators.search import postings, token_stats
from leafmill.plans.flow import run_flow
from leafmill.plans.queries import QUERIES
from leafmill.plans.render import rendered_pages
from leafmill.session import local_session

HEADLINE = (
    "page_keys", "labelled_fields", "sub_entries", "notes_bullets", "cross_refs",
    "assemble_global", "assemble_runs", "page_runs", "page_manifest", "key_pages", "event_runs",
    "first_pages_ranked", "page_chunks", "row_ids", "table_frn", "table_frn_sub_entry",
    "table_frn_note", "table_frn_cross_reference", "table_frn_pdf", "upserted_search_text",
    "table_lookup", "json_roundtrip", "load_report", "duplicate_keys", "known_only", "orphans",
    "referential_violations", "blob_report", "search_text", "token_index", "term_search",
    "prefix_search", "suffix_search", "html_links",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = local_session("bench", cpus, memory="16g", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="run-")

    page_path = f"{folder}/pages"
    rendered_pages(spark, sf_dir).repartitionByRange(4 * int(cpus), "doc_id", "page_idx") \
        .sortWithinPartitions("doc_id", "page_idx").write.parquet(page_path)
    pages = spark.read.parquet(page_path)
    n_pages = pages.count()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(int(cpus))
    drain(page_extract(pages.limit(1000)))

    stages = {
        "extract_pages": timed(lambda: drain(page_extract(pages))),
        "keys_fields_assembly": timed(lambda: drain(records(pages))),
        "assembly_by_runs": timed(lambda: drain(records(pages, "runs"))),
        "page_manifest": timed(lambda: drain(page_manifest(pages))),
        "five_tables_counted": timed(lambda: load_report(tables(records(pages))).collect()),
        "full_load": timed(lambda: run_flow(spark, pages, f"{folder}/flow").load_report.collect()),
        "search_text_and_index": timed(lambda: drain(token_stats(
            postings(search_text_of(docs, "text"), "doc_id"), "doc_id"))),
    }
    queries = {}
    for name in HEADLINE:
        queries[name] = timed(lambda: drain(QUERIES[name](spark, sf_dir)))
        print(name, queries[name], file=sys.stderr)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "pages": n_pages,
        "stages": stages,
        "pages_per_sec": {k: round(n_pages / v) for k, v in stages.items() if k != "search_text_and_index"},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
