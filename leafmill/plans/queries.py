"""Registered queries: each reads the given tables and runs over all of their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import keys, links, text
from leafmill.functions.search import register_functions, search_text_of, with_full_text
from leafmill.operators import (
    assemble, blocks, ids, integrity, manifest, normalize, pages, runs, search,
)
from leafmill.plans.flow import run_flow
from leafmill.plans.render import dealt, line_pages, rendered_pages, table
from leafmill.session import scratch_path, settle
from leafmill.sources.blobs import list_files, read_blobs, write_files
from leafmill.sources.keyed import KeyedTable, PostingIndex
from leafmill.sources.pages import read_paged_text, split_pages
from leafmill.sources.records import read_records, write_record_array, write_record_arrays, write_records
from leafmill.sources.tables import read_table, write_table
from leafmill.spec import (
    DEFAULT_SPEC, LOOKUP_COLUMNS, TABLE_BLOB, TABLE_NOTE, TABLE_RECORD, TABLE_SUB, TABLE_XREF,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
FIELDS = DEFAULT_SPEC.field_names


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _joined(column, inner=lambda x: x.cast("string")):
    return F.array_join(F.transform(column, inner), ",")


def _records(spark, sf, mode="global"):
    return assemble.records(rendered_pages(spark, sf), mode)


# ------------------------------------------------------------------- pages
@query
def paged_text(spark, sf):
    docs = table(spark, sf, "documents")
    split = split_pages(docs, separator="\n")
    return pages.non_empty(split).select("doc_id", "page_idx", F.md5("text").alias("text_md5"))


@query
def paged_text_files(spark, sf):
    """Documents of each source as pages of form-feed separated files, read back by the file reader."""
    folder = scratch_path(spark, "paged_text_files")
    (table(spark, sf, "documents").select("text", "source", "doc_id").repartition("source")
     .sortWithinPartitions("source", "doc_id").drop("doc_id")
     .write.partitionBy("source").option("lineSep", "\f").text(folder))
    return read_paged_text(spark, folder).select("page_idx", F.md5("text").alias("text_md5"))


@query
def text_lines(spark, sf):
    lines = pages.text_lines(table(spark, sf, "documents"), "doc_id")
    return lines.select("doc_id", "line_idx", F.md5("line").alias("line_md5"))


@query
def page_head(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.head(F.col("text"), DEFAULT_SPEC.head_chars).alias("head"))


@query
def page_keys(spark, sf):
    body = F.col("text")
    return pages.non_empty(rendered_pages(spark, sf)).select(
        "doc_id", "page_idx",
        keys.page_key(body).alias("page_key"),
        keys.head_key(body).alias("parent_key"),
    ).withColumn("is_sub_entry", keys.is_sub_entry(F.col("page_key")).cast("int"))


@query
def labelled_fields(spark, sf):
    out = pages.parent_pages(rendered_pages(spark, sf)).transform(pages.with_fields)
    return out.select("doc_id", "page_idx", "frn", "printed_key", *FIELDS)


@query
def indirect_values(spark, sf):
    out = pages.parent_pages(rendered_pages(spark, sf)).transform(pages.with_fields)
    return pages.with_value(out, "make").select(
        "doc_id", "page_idx", "frn", "year_dates", "serial_numbering")


@query
def sub_entries(spark, sf):
    parsed = line_pages(spark, sf).transform(pages.with_sub_entries)
    rows = parsed.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.posexplode_outer("sub_entries").alias("pos", "e"))
    return rows.filter(F.col("pos").isNotNull()).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "pos",
        F.col("e.frn").alias("sub_frn"), "e.calibre", "e.shots", "e.barrel_length",
        F.col("e.legal_classification").alias("legal_classification"))


@query
def notes_bullets(spark, sf):
    noted = pages.parent_pages(rendered_pages(spark, sf)).transform(pages.with_notes)
    return normalize.explode_notes(noted, "doc_id", "page_idx")


@query
def cross_refs(spark, sf):
    noted = pages.parent_pages(rendered_pages(spark, sf)).transform(pages.with_cross_references)
    return normalize.explode_cross_references(noted, "doc_id", "page_idx")


@query
def camel_case(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", text.camel_case(F.col("p_name")).alias("camel"))


@query
def whitespace_collapse(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.collapse(F.col("text"))).alias("collapsed_md5"))


# ---------------------------------------------------------------- assembly
def _summary(records):
    return records.select(
        "doc_id", "first_page_idx", "n_pages", "frn", *FIELDS,
        *[F.coalesce(F.size(c), F.lit(0)).alias(f"n_{c}")
          for c in ("notes", "sub_entries", "cross_references")])


@query
def assemble_global(spark, sf):
    return _summary(_records(spark, sf))


@query
def assemble_runs(spark, sf):
    return _summary(_records(spark, sf, "runs"))


def _run_parts(spark, sf):
    return settle(manifest.run_parts(settle(manifest.keyed_positions(rendered_pages(spark, sf)))))


def _runs(parts):
    return manifest.page_runs(parts).select("doc_id", "frn", "run_start", "run_end", "n_pages")


@query
def page_runs(spark, sf):
    return _runs(_run_parts(spark, sf))


@query
def last_runs(spark, sf):
    return _runs(manifest.last_parts(_run_parts(spark, sf)))


def _manifest(spark, sf, last_only):
    return manifest.page_manifest(rendered_pages(spark, sf), last_only=last_only, part=2).select(
        "doc_id", "frn", "run_start", "part", "n_pages",
        _joined("page_indices").alias("page_indices"))


@query
def page_manifest(spark, sf):
    return _manifest(spark, sf, last_only=True)


@query
def page_manifest_all_runs(spark, sf):
    return _manifest(spark, sf, last_only=False)


@query
def key_pages(spark, sf):
    kept = manifest.last_parts(_run_parts(spark, sf))
    return manifest.key_pages(rendered_pages(spark, sf), kept).select(
        "doc_id", "frn", "run_start", "page_idx",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("first_line"))


@query
def event_runs(spark, sf):
    """Runs of event types in blocks of 5,000 events; some keys are NULL and some are ''."""
    key = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 5 < 2, "").otherwise(
        F.substring("event_type", 1, 1))
    events = table(spark, sf, "events").select(
        F.expr("event_id DIV 5000").alias("part"), "event_id", key.alias("kind"))
    return runs.runs(events, "kind", doc="part", pos="event_id", partitions=16).select(
        "part", "kind", "run_start", "run_end", F.col("n_pages").alias("n_events"))


# ------------------------------------------------------------ ranges, order
@query
def first_pages(spark, sf):
    return pages.first_pages(table(spark, sf, "conversations"), 3, doc="conv_id", pos="turn").select(
        "conv_id", "turn", "role")


@query
def first_pages_ranked(spark, sf):
    return pages.first_pages(
        table(spark, sf, "documents"), 100, doc="lang", pos="doc_id", dense=False,
    ).select("lang", "doc_id", "n_chars")


@query
def first_events_ranked(spark, sf):
    return pages.first_pages(
        table(spark, sf, "events"), 1500, doc="event_type", pos="event_id", dense=False,
    ).select("event_type", "event_id")


@query
def page_range(spark, sf):
    return pages.page_range(table(spark, sf, "conversations"), 1, 4, pos="turn").select(
        "conv_id", "turn", "role")


@query
def page_chunks(spark, sf):
    return pages.with_chunk(
        table(spark, sf, "conversations"), 3, doc="conv_id", pos="turn").select(
        "conv_id", "turn", "chunk")


@query
def union_pages(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("doc_id"), F.lit(0).cast("bigint").alias("page_idx"),
        "text", "lang")
    turns = table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), "conv_id").alias("doc_id"), F.col("turn").alias("page_idx"), "text")
    both = pages.in_document_order(pages.union_pages(docs, turns))
    return both.select("doc_id", "page_idx", "lang", F.md5("text").alias("text_md5"))


@query
def row_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return ids.with_row_id(orders, "o_orderdate", "o_orderkey").select("id", "o_orderkey")


# ------------------------------------------------------------------ tables
@query
def keyed_records(spark, sf):
    priority = F.col("o_orderpriority")
    rows = table(spark, sf, "orders").select(
        F.when(priority == "1-URGENT", "").when(priority != "5-LOW", F.col("o_orderkey").cast("string"))
        .alias("frn"), F.col("o_orderstatus").alias("status"))
    return normalize.keyed_records(rows)


@query
def table_frn(spark, sf):
    return normalize.record_table(_records(spark, sf))


@query
def table_frn_sub_entry(spark, sf):
    return normalize.sub_entry_table(_records(spark, sf), "first_page_idx")


@query
def table_frn_note(spark, sf):
    return normalize.note_table(_records(spark, sf))


@query
def table_frn_cross_reference(spark, sf):
    return normalize.cross_reference_table(_records(spark, sf), "first_page_idx")


@query
def table_ids(spark, sf):
    made = normalize.tables(settle(_records(spark, sf)), None, *normalize.ORDER)
    notes = normalize.with_table_ids({TABLE_NOTE: made[TABLE_NOTE]})[TABLE_NOTE]
    return notes.select("id", "frn", "note_key", "bullet_index")


def _document_files(spark, sf):
    return table(spark, sf, "documents").select(
        F.concat(F.lit("/blobs/"), "lang", F.lit("/v1."), "doc_id", F.lit(".pdf")).alias("path"),
        F.encode("text", "UTF-8").alias("content"))


@query
def blob_base64(spark, sf):
    return normalize.blob_rows(_document_files(spark, sf)).select(
        "frn", F.md5("pdf64").alias("pdf64_md5"), F.length("pdf64").alias("n_chars"))


@query
def table_frn_pdf(spark, sf):
    files = table(spark, sf, "documents").select(
        F.concat(F.lit("/blobs/"), "doc_id", F.lit(".pdf")).alias("path"),
        F.encode("text", "UTF-8").alias("content"))
    known = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("frn"))
    return normalize.blob_rows(files, known).select("frn", F.md5("pdf64").alias("pdf64_md5"))


def _page_files(spark, sf):
    """Every page as a file of its own: some are empty, some keys have a second file in a later folder, some have another ending."""
    folder = scratch_path(spark, "page_files")
    html = F.when(F.col("page_id") % 7 != 0, F.encode("html", "UTF-8")).otherwise(F.expr("X''"))

    def file(where: str, ending: str, content):
        return F.struct(F.concat(F.lit(where + "/"), "page_id", F.lit(ending)).alias("name"), content.alias("content"))

    second = F.encode(F.concat(F.lit("second "), "page_id"), "UTF-8")
    every = F.array(
        file("a", ".pdf", html), F.when(F.col("page_id") % 10 == 0, file("b", ".pdf", second)),
        F.when(F.col("page_id") % 50 == 0, file("b", ".txt", second)))
    write_files(table(spark, sf, "pages").select(F.explode_outer(F.filter(every, lambda f: f.isNotNull())).alias("f")).select("f.*"), folder)
    return folder


@query
def file_blobs(spark, sf):
    """Files read back by pattern, through all folders, the empty ones too; the lowest path of a key is loaded."""
    return read_blobs(spark, _page_files(spark, sf), recursive=True).select(
        "frn", F.md5("pdf64").alias("pdf64_md5"), F.length("pdf64").alias("n_chars"))


@query
def file_list(spark, sf):
    """Files in the order of their paths, without their contents."""
    listed = list_files(spark, _page_files(spark, sf), recursive=True)
    return ids.with_row_id(listed, "path").select(
        "id", "frn", F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("folder"), "length")


@query
def upserted_search_text(spark, sf):
    current = settle(normalize.record_table(_records(spark, sf)))
    changes = current.filter(F.col("level") == "").drop("fullText").withColumn(
        "make", F.concat(F.lit("changed-"), "frn"))
    return normalize.upsert(current, changes, TABLE_RECORD).select("frn", "make", "fullText")


def _frn(modulus, rest=0):
    return F.col("frn").cast("long") % modulus == rest


def _updated(spark, rows, keys, name, gone, changed, added):
    """A stored child table after a merge of conditions on its rows: (table, changes with their text, deleted keys)."""
    rows = settle(rows, "child-rows")
    stored = KeyedTable.create(spark, scratch_path(spark, "keyed"), rows, keys, buckets=16)
    condition, column, value = changed
    changes = rows.where(condition & ~gone).withColumn(column, value)
    condition, values = added
    new = rows.where(condition).withColumns(values)
    changes = settle(with_full_text(changes.unionByName(new).drop("fullText"), name), "changes")
    deleted = rows.where(gone)
    return rows, stored.merge(changes, deleted), changes, deleted


def _updated_notes(spark, sf):
    return _updated(
        spark, normalize.note_table(_records(spark, sf)), NOTE_KEY, TABLE_NOTE,
        _frn(7) & (F.col("bullet_index") == 1),
        (_frn(5), "note_value", F.concat("note_value", F.lit(" amended"))),
        (_frn(11) & (F.col("bullet_index") == 0), {"bullet_index": F.lit(100), "note_value": F.lit("An added note")}))


@query
def updated_notes(spark, sf):
    """Bullets deleted, changed and added by their keys; text of the changed ones is computed."""
    return _updated_notes(spark, sf)[1].rows()


@query
def updated_sub_entries(spark, sf):
    _, table_, _, _ = _updated(
        spark, normalize.sub_entry_table(_records(spark, sf), "first_page_idx"), ("frn", "pos"), TABLE_SUB,
        _frn(7) & (F.col("pos") == 0), (_frn(5), "shots", F.lit("9 shots")),
        (_frn(11) & (F.col("pos") == 0), {"pos": F.lit(100), "calibre": F.lit("new")}))
    return table_.rows()


@query
def updated_cross_references(spark, sf):
    _, table_, _, _ = _updated(
        spark, normalize.cross_reference_table(_records(spark, sf), "first_page_idx"), ("frn", "pos"), TABLE_XREF,
        _frn(7) & (F.col("pos") == 0), (_frn(5), "description", F.concat(F.lit("see "), "description")),
        (_frn(11) & (F.col("pos") == 0), {"pos": F.lit(100), "description": F.lit("added")}))
    return table_.rows()


@query
def updated_note_lookup(spark, sf):
    """Postings that follow the changes of the notes, before and after they are compacted."""
    rows, _, changes, deleted = _updated_notes(spark, sf)
    index = PostingIndex.create(spark, scratch_path(spark, "posting_index"), rows, NOTE_KEY).apply(changes, deleted)
    out = None
    for kind, state in (("parts", index), ("compact", index.compact())):
        found = search.term_lookup(state.live(), "wrapped; tail", NOTE_KEY).union(search.prefix_lookup(state.live(), "amend", NOTE_KEY))
        found = found.union(search.suffix_lookup(state.live(), "dded", NOTE_KEY)).withColumn("state", F.lit(kind))
        out = found if out is None else out.union(found)
    return out


@query
def table_lookup(spark, sf):
    folder = scratch_path(spark, "table_lookup")
    write_table(normalize.record_table(_records(spark, sf)), folder, TABLE_RECORD)
    stored = read_table(spark, folder, TABLE_RECORD)
    return search.lookup(stored, country="ASIA", type="F").select("frn", "country", "type", "make")


def _clustered(spark, rows, name):
    """A table laid out by all its lookup columns together, read back."""
    folder = scratch_path(spark, "clustered")
    write_table(rows, folder, name, cluster=LOOKUP_COLUMNS[name])
    return read_table(spark, folder, name)


@query
def clustered_lookup(spark, sf):
    stored = _clustered(spark, normalize.record_table(_records(spark, sf)), TABLE_RECORD)
    return search.lookup(stored, legal_classification="Antique", country="EUROPE").select("frn", "country", "legal_classification", "make")


@query
def sub_entry_lookup(spark, sf):
    stored = _clustered(spark, normalize.sub_entry_table(_records(spark, sf)), TABLE_SUB)
    return search.lookup(stored, calibre="308 WIN", legal_classification="CC 84(3) Exempted").select("frn", "sub_frn", "shots", "barrel_length")


@query
def note_lookup(spark, sf):
    stored = _clustered(spark, normalize.note_table(_records(spark, sf)), TABLE_NOTE)
    return search.lookup(stored, frn="34", note_key="legalLawComments").select("frn", "note_key", "bullet_index", "note_value")


@query
def cross_reference_lookup(spark, sf):
    stored = _clustered(spark, normalize.cross_reference_table(_records(spark, sf)), TABLE_XREF)
    return search.lookup(stored, frn="34").select("frn", "ref_frn", "description")


@query
def blob_lookup(spark, sf):
    stored = _clustered(spark, normalize.blob_rows(_document_files(spark, sf)), TABLE_BLOB)
    return search.lookup(stored, frn="v1.17").select("frn", F.md5("pdf64").alias("pdf64_md5"))


@query
def appended_records(spark, sf):
    """Records in two loads; the keys of the second are tested against those stored."""
    rows = settle(normalize.record_table(_records(spark, sf)))
    later = F.crc32("frn") % 3 == 0
    stored = KeyedTable.create(spark, scratch_path(spark, "appended"), rows.where(~later), ["frn"], buckets=8)
    return stored.append(rows.where(later)).rows().select("frn", "make", "fullText")


@query
def replaced_key_pages(spark, sf):
    """Page groups stored by key; a second load of every fifth key, with the first page of each only, replaces these keys."""
    kept = manifest.last_parts(_run_parts(spark, sf))
    grouped = settle(manifest.key_pages(rendered_pages(spark, sf), kept), "grouped")
    stored = KeyedTable.create(spark, scratch_path(spark, "key_pages"), grouped, PAGE_KEY, buckets=64)
    again = grouped.where(_frn(5) & (F.col("page_idx") == F.col("run_start"))).withColumn("text", F.concat(F.lit("again "), "text"))
    return stored.replace(again, ("doc_id", "frn")).rows().select(
        "doc_id", "frn", "run_start", "page_idx", F.split_part("text", F.lit("\n"), F.lit(1)).alias("first_line"))


@query
def json_roundtrip(spark, sf):
    folder = scratch_path(spark, "json_roundtrip")
    write_records(settle(_records(spark, sf)), folder)
    return normalize.note_table(read_records(spark, folder, "lines"))


@query
def json_array_roundtrip(spark, sf):
    """All records as one JSON array in framed part files, lexed in parallel."""
    folder = scratch_path(spark, "json_array")
    write_record_array(settle(_records(spark, sf)), folder)
    return normalize.note_table(read_records(spark, folder, "parts"))


@query
def json_mixed_layouts(spark, sf):
    """Files of lines and files that each hold an array, side by side in one folder."""
    folder = scratch_path(spark, "json_mixed")
    records = settle(_records(spark, sf))
    even = F.crc32("frn") % 2 == 0
    write_records(records.where(even), folder)
    write_record_arrays(records.where(~even), folder, mode="append")
    return normalize.note_table(read_records(spark, folder))


@query
def load_report(spark, sf):
    return integrity.load_report(normalize.tables(settle(_records(spark, sf))))


@query
def full_load_by_runs(spark, sf):
    result = run_flow(
        spark, rendered_pages(spark, sf), scratch_path(spark, "full_load"), mode="runs")
    return result.load_report


@query
def flow_report(spark, sf):
    """A whole load with blobs: some keys have two files, some files have no record."""
    files = table(spark, sf, "orders").select(
        F.explode(F.when(F.col("o_orderkey") % 10 == 0, F.array(F.lit("/a/"), F.lit("/b/"))).otherwise(F.array(F.lit("/a/"))))
        .alias("folder"), (F.col("o_orderkey") * 3).alias("k")).select(
        F.concat("folder", "k", F.lit(".pdf")).alias("path"), F.encode(F.col("k").cast("string"), "UTF-8").alias("content"))
    return run_flow(spark, rendered_pages(spark, sf), scratch_path(spark, "flow_report"), blobs=files).report


# --------------------------------------------------------------- integrity
@query
def duplicate_keys(spark, sf):
    return integrity.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query
def duplicate_record_keys(spark, sf):
    return integrity.duplicate_keys(_records(spark, sf, "runs"), "frn")


@query
def known_only(spark, sf):
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return integrity.known_only(orders, items, "o_orderkey", "l_orderkey").select(
        "o_orderkey", "o_orderstatus")


@query
def orphans(spark, sf):
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return integrity.orphans(orders, items, "o_orderkey", "l_orderkey").select(
        "o_orderkey", "o_orderstatus")


@query
def referential_violations(spark, sf):
    def key(name, column):
        return table(spark, sf, name).select(F.col(column).alias("frn"))

    return integrity.referential_violations({
        TABLE_RECORD: key("labels", "doc_id"),
        TABLE_SUB: key("orders", "o_custkey"),
        TABLE_NOTE: key("lineitem", "l_orderkey"),
        TABLE_XREF: key("conversations", "conv_id"),
        TABLE_BLOB: key("documents", "doc_id"),
    })


@query
def blob_report(spark, sf):
    blobs = table(spark, sf, "documents").select(F.col("doc_id").alias("frn"))
    return integrity.blob_report(blobs, table(spark, sf, "labels").select(F.col("doc_id").alias("frn")))


@query
def first_errors(spark, sf):
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    rejects = integrity.orphans(orders, items, "o_orderkey", "l_orderkey").select(
        F.concat(F.lit("order "), "o_orderkey", F.lit(" has no line items")).alias("reason"))
    return integrity.first_errors(rejects, "reason")


# ------------------------------------------------------------------ search
@query
def search_text_sql(spark, sf):
    register_functions(spark)
    return spark.sql(
        "SELECT p_partkey, fulltextify(concat_ws(' ', p_name, p_brand, p_type)) AS fullText FROM {part}",
        part=table(spark, sf, "part"))


@query
def search_text(spark, sf):
    return search_text_of(table(spark, sf, "documents"), "text").select(
        "doc_id", F.md5("fullText").alias("full_text_md5"))


def _searchable_documents(spark, sf):
    """The search text is a stored column, so it is settled before it is searched."""
    docs = dealt(table(spark, sf, "documents").select("doc_id", "lang", "text"), "doc_id")
    return settle(search_text_of(docs, "text").drop("text"))


def _searchable_parts(spark, sf):
    named = table(spark, sf, "part").select(
        "p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("words"))
    return search_text_of(named, "words")


@query
def token_index(spark, sf):
    return search.token_stats(search.postings(_searchable_documents(spark, sf), "doc_id"), "doc_id")


@query
def token_postings(spark, sf):
    return search.postings(_searchable_parts(spark, sf), "p_partkey")


@query
def term_search(spark, sf):
    return search.term_search(_searchable_documents(spark, sf), "The, on").select("doc_id", "lang")


@query
def prefix_search(spark, sf):
    return search.prefix_search(_searchable_documents(spark, sf), "Ment").select("doc_id", "lang")


@query
def suffix_search(spark, sf):
    return search.suffix_search(_searchable_documents(spark, sf), "sch").select("doc_id", "lang")


@query
def term_lookup(spark, sf):
    posted = search.postings(_searchable_parts(spark, sf), "p_partkey")
    return search.term_lookup(posted, "small Ring", "p_partkey")


@query
def prefix_lookup(spark, sf):
    posted = search.postings(_searchable_parts(spark, sf), "p_partkey")
    return search.prefix_lookup(posted, "brand#1", "p_partkey")


@query
def suffix_lookup(spark, sf):
    posted = search.postings(_searchable_parts(spark, sf), "p_partkey")
    return search.suffix_lookup(posted, "ing", "p_partkey")


NOTE_KEY = ("frn", "note_key", "bullet_index")
PAGE_KEY = ("doc_id", "frn", "page_idx")


def _stored_note_postings(spark, sf):
    """Postings of the note table, written in token order and read back."""
    folder = scratch_path(spark, "note_postings")
    search.write_postings(search.postings(normalize.note_table(_records(spark, sf)), NOTE_KEY), folder)
    return spark.read.parquet(folder)


@query
def note_term_lookup(spark, sf):
    return search.term_lookup(_stored_note_postings(spark, sf), "Bullet of; tail", NOTE_KEY)


@query
def note_block_lookup(spark, sf):
    """Two frequent terms and a rare one, in stored blocks of postings."""
    folder = scratch_path(spark, "note_blocks")
    posted = search.postings(normalize.note_table(_records(spark, sf)), NOTE_KEY, mirrored=False)
    blocks.write_blocks(blocks.posting_blocks(posted, NOTE_KEY, block=256), folder)
    return blocks.block_lookup(spark.read.parquet(folder), "Bullet of; 34", NOTE_KEY)


@query
def note_prefix_lookup(spark, sf):
    return search.prefix_lookup(_stored_note_postings(spark, sf), "Mark", NOTE_KEY)


@query
def note_suffix_lookup(spark, sf):
    return search.suffix_lookup(_stored_note_postings(spark, sf), "ail", NOTE_KEY)


# ------------------------------------------------------------------- links
LINK_NAME = r"[A-Za-z]{4,}\.?"


@query
def html_links(spark, sf):
    found = table(spark, sf, "pages").select(
        "page_id", "url", F.posexplode_outer(links.matching_links(F.col("html"), LINK_NAME)).alias("pos", "href"))
    return found.filter(F.col("pos").isNotNull()).select(
        "page_id", "pos", "href", links.file_name(F.col("href")).alias("file_name"),
        links.absolute_url(F.col("href"), F.col("url")).alias("abs_url"))


@query
def first_link(spark, sf):
    found = table(spark, sf, "pages").select(
        "page_id", "url", links.first_link(F.col("html"), LINK_NAME).alias("href"))
    return found.select(
        "page_id", "href", links.absolute_url(F.col("href"), F.col("url")).alias("abs_url"))
