"""Small operators, and what the plans look like."""

import pytest
from pyspark.sql import functions as F

from leafmill.functions import links, text
from leafmill.functions.search import register_functions, search_text_of, tokens, with_full_text
from leafmill import session
from leafmill.operators import assemble, ids, integrity, manifest, normalize, pages, runs, search
from leafmill.plans.queries import QUERIES
from leafmill.plans.render import rendered_pages
from leafmill.sources.tables import read_table, write_table
from leafmill.spec import LINK_FILE_PATTERN, TABLE_NOTE, TABLE_RECORD


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(expr.alias("x")).collect()[0]["x"]


@pytest.mark.parametrize("given,want", [
    ("a-b (c)", "aDSHb c c bHSDa"), ("  .x. ", "x x"), ("", ""), ("()", ""), (" ", ""), ("é\ta", "é\ta a\té"),
    ("-", "DSH HSD"), ("a'b\"c\\`d", "abc\\d d\\cba"),
])
def test_fulltextify(spark, given, want):
    register_functions(spark)
    df = spark.createDataFrame([(given,)], "s string")
    row = df.selectExpr("fulltextify(s) AS a").collect()[0]
    assert row["a"] == want
    assert search_text_of(df, "s").collect()[0]["fullText"] == want


def test_fulltextify_of_null(spark):
    register_functions(spark)
    assert spark.sql("SELECT fulltextify(NULL) AS a").collect()[0]["a"] is None


def test_full_text_follows_updates(spark):
    df = spark.createDataFrame([("x-y", 0, "stale")], "note_value string, bullet_index int, fullText string")
    assert with_full_text(df, TABLE_NOTE).collect()[0]["fullText"] == "xDSHy 0 0 yHSDx"


@pytest.mark.parametrize("path,stem", [
    ("/a/b/12.pdf", "12"), ("file:/a.b/12", "12"), ("x.tar.pdf", "x.tar"), ("/a/.pdf", ".pdf"),
    ("..x.y", "..x"), ("12.", "12"),
])
def test_file_stem(spark, path, stem):
    assert one(spark, text.file_stem(F.col("p")), p=path) == stem


@pytest.mark.parametrize("label,want", [
    ("Serial Number", "serialNumber"), ("MAKE", "make"), ("a  bC\tdé fg", "aBcDéFg")])
def test_camel_case(spark, label, want):
    assert one(spark, text.camel_case(F.col("s")), s=label) == want


HTML = """<html><!-- <a href="/x/frt-0.pdf"> --><script>var s='<a href="/frt-1.pdf">';</script>
<A class='n' title="a > b" HREF = '/docs/FRT-22.PDF'>x</a> <area href="/frt-3.pdf">
<a data-href="/frt-4.pdf" href=/en/frt-5.pdf>y</a><a href="https://h/q?a=1&amp;b=/frt-6.pdf">z</a>
<a href="/frt-7.pdf.html">n</a><a name="k">n</a><a href="/my-frt-8.pdf">n</a></html>"""


def test_links(spark):
    found = one(spark, F.array_join(links.matching_links(F.col("h")), "|"), h=HTML)
    assert found == "/docs/FRT-22.PDF|/en/frt-5.pdf|https://h/q?a=1&b=/frt-6.pdf"
    assert one(spark, links.first_link(F.col("h"), LINK_FILE_PATTERN), h=HTML) == "/docs/FRT-22.PDF"
    assert one(spark, links.first_link(F.col("h")), h="<p>none</p>") is None


@pytest.mark.parametrize("href,page,want", [
    ("/a.pdf", "https://h.org/en/x/en/y", "https://h.org/a.pdf"),
    ("/a.pdf", "https://h.org/fr/x", "https://h.org/fr/x/a.pdf"),
    ("http://o/a.pdf", "https://h.org/en/", "http://o/a.pdf"),
])
def test_absolute_url(spark, href, page, want):
    assert one(spark, links.absolute_url(F.col("h"), F.col("p")), h=href, p=page) == want


def test_tokens_are_distinct_and_not_empty(spark):
    assert one(spark, F.array_join(tokens(F.col("s")), "|"), s=" A b\n\na  C ") == "a|b|c"


def searchable(spark):
    rows = [(1, "Semi-Auto rifle (x)"), (2, "rifle elfir"), (3, "auto"), (4, "")]
    return search_text_of(spark.createDataFrame(rows, "id int, s string"), "s")


@pytest.mark.parametrize("scan,stored,arg,want", [
    (search.term_search, search.term_lookup, "RIFLE", [1, 2]),
    (search.term_search, search.term_lookup, "semi-auto, rifle", [1]),
    (search.term_search, search.term_lookup, "semi", []),
    (search.prefix_search, search.prefix_lookup, "Sem", [1]),
    (search.prefix_search, search.prefix_lookup, "au", [3]),
    (search.suffix_search, search.suffix_lookup, "auto", [1, 3]),
    (search.suffix_search, search.suffix_lookup, "fle", [1, 2]),
    (search.prefix_search, search.prefix_lookup, "elf", [2]),
])
def test_search(spark, scan, stored, arg, want):
    df = searchable(spark)
    assert sorted(r["id"] for r in scan(df, arg).collect()) == want
    assert sorted(r["id"] for r in stored(search.postings(df, "id"), arg, "id").collect()) == want


def test_search_needs_one_term(spark):
    with pytest.raises(ValueError):
        search.prefix_search(searchable(spark), "two words")


def test_stored_postings_prune(spark, tmp_path):
    path = str(tmp_path / "p")
    search.write_postings(search.postings(searchable(spark), "id"), path, 2)
    hits = search.prefix_lookup(spark.read.parquet(path), "rif", "id")
    assert sorted(r["id"] for r in hits.collect()) == [1, 2]
    assert "StringStartsWith(token,rif)" in plan(hits)


def test_row_ids_are_dense(spark):
    df = spark.range(5000).select((F.hash("id")).alias("h"), "id")
    got = ids.with_row_id(df, "h", "id", name="row", partitions=7).collect()
    assert sorted(r["row"] for r in got) == list(range(1, 5001))
    by_row = sorted(got, key=lambda r: r["row"])
    assert [(r["h"], r["id"]) for r in by_row] == sorted((r["h"], r["id"]) for r in got)


def test_chunks(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 0)], "doc_id string, page_idx bigint")
    rows = {(r["doc_id"], r["page_idx"]): r["chunk"] for r in pages.with_chunk(df, 3).collect()}
    assert [rows["a", i] for i in range(10)] == [0] * 4 + [1] * 4 + [2] * 2
    assert rows["b", 0] == 0
    wide = spark.range(200000).select(F.lit("h").alias("doc_id"), F.col("id").alias("page_idx"))
    sizes = pages.with_chunk(wide, 4).groupBy("chunk").count().collect()
    assert {r["chunk"]: r["count"] for r in sizes} == {i: 50000 for i in range(4)}
    fixed = pages.with_chunk(df, 3, total=10).filter("doc_id = 'a'").collect()
    assert {r["page_idx"]: r["chunk"] for r in fixed} == {i: i // 4 for i in range(10)}


@pytest.mark.parametrize("n", [10, 1500])
def test_first_pages_of_sparse_positions(spark, n):
    df = spark.range(4000).select(
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("doc_id"), (F.col("id") * 97).alias("page_idx"))
    got = pages.first_pages(df, n, dense=False)
    assert got.columns == ["doc_id", "page_idx"]
    rows = sorted(map(tuple, got.collect()))
    every = [("a" if i % 4 == 0 else "b", i * 97) for i in range(4000)]
    want = sorted([r for r in every if r[0] == "a"][:n] + [r for r in every if r[0] == "b"][:n])
    assert rows == want


def test_require_unique(spark):
    df = spark.createDataFrame([("1",), ("2",)], "frn string")
    integrity.require_unique(df, "frn")
    with pytest.raises(ValueError):
        integrity.require_unique(df.union(df), "frn")


def test_first_errors(spark):
    df = spark.range(25).select(F.format_string("e%02d", "id").alias("m"))
    rows = [(r["message"], r["n_more"]) for r in integrity.first_errors(df, "m").collect()]
    assert rows[:20] == [(f"e{i:02d}", None) for i in range(20)] and rows[20:] == [("... and more", 5)]
    assert len(integrity.first_errors(df.limit(20), "m").collect()) == 20


def test_orphans_with_null_keys(spark):
    child = spark.createDataFrame([("1",), (None,), ("3",)], "frn string")
    parent = spark.createDataFrame([("1",), (None,)], "frn string")
    assert [r["frn"] for r in integrity.known_only(child, parent, "frn").collect()] == ["1"]
    assert sorted(str(r["frn"]) for r in integrity.orphans(child, parent, "frn").collect()) == ["3", "None"]


def test_key_of_most_pages_becomes_one_record(spark):
    """A hot key next to ordinary ones, its pages far apart."""
    label = "Firearm Reference Number (FRN): "
    df = spark.range(30000).select(
        F.lit("d").alias("doc_id"), F.col("id").alias("page_idx"),
        F.concat(F.lit(label), F.when(F.col("id") % 3 > 0, "7").otherwise(F.col("id") + 100),
                 F.lit("\nMake: m"), F.col("id"), F.lit("\n")).alias("text"))
    out = {r["frn"]: r for r in assemble.records(df).collect()}
    assert len(out) == 10001
    assert (out["7"]["n_pages"], out["7"]["make"], out["7"]["first_page_idx"]) == (20000, "m29999", 1)
    runs = assemble.records(df, "runs")
    assert runs.count() == 20000
    assert runs.filter("frn = '7'").agg(F.sum("n_pages")).collect()[0][0] == 20000


# ------------------------------------------------------------------- plans
def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_pages(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages"))
    rendered_pages(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_extraction_does_not_shuffle(stored_pages):
    text_plan = plan(pages.page_extract(stored_pages))
    assert "Exchange" not in text_plan and "Python" not in text_plan
    assert "StringContains(text,Firearm Reference Number (FRN):)" in text_plan


def test_global_assembly_shuffles_once_after_partial_merge(stored_pages):
    text_plan = plan(assemble.records(stored_pages))
    assert text_plan.count("Exchange") == 1
    assert "partial_max_by" in text_plan and "partial_min_by" in text_plan


def test_keys_read_no_more_than_needed(stored_pages):
    text_plan = plan(assemble.records(stored_pages).groupBy("page_key").count())
    assert "regexp_extract_all" not in text_plan


def test_runs_settle_keys_alone(stored_pages, monkeypatch):
    settled = []

    def settle(df, *name):
        settled.append(df.columns)
        return session.settle(df, *name)

    monkeypatch.setattr(assemble, "settle", settle)
    found = assemble.records(stored_pages, "runs")
    assert settled == [["doc_id", "page_idx", "frn"]]
    assert "regexp_extract_all" not in plan(integrity.duplicate_keys(found, "frn"))
    wanted = assemble.assemble_runs(session.settle(pages.page_extract(stored_pages)))
    assert found.count() == wanted.count() and found.exceptAll(wanted).isEmpty()


def test_heads_are_cut_once(stored_pages):
    assert plan(manifest.keyed_positions(stored_pages)).count("substring(text") == 1


def test_lookup_is_pushed_down(spark, stored_pages, tmp_path):
    write_table(normalize.record_table(assemble.records(stored_pages)), str(tmp_path), TABLE_RECORD)
    found = search.lookup(read_table(spark, str(tmp_path), TABLE_RECORD), make="Customer#000000001")
    assert "EqualTo(make,Customer#000000001)" in plan(found.select("frn"))
    assert found.count() > 0


def test_hot_document_is_not_one_window_group(stored_pages):
    text_plan = plan(manifest.run_parts(manifest.keyed_positions(stored_pages)))
    assert "hashpartitioning(doc_id" in text_plan
    assert "_block" in text_plan.split("Window", 1)[1]


def test_first_pages_rank_positions_without_text(stored_pages):
    text_plan = plan(pages.first_pages(stored_pages, 10, dense=False))
    window = text_plan.split("Window [row_number()", 1)[1]
    assert "text#" not in window.split("Scan parquet", 1)[0]


@pytest.mark.parametrize("n", [1, 2, 999, 1000, 1001, 70_000])
def test_first_pages_are_the_same_rule_for_every_n(spark, n):
    rows = [("d", 3 * k) for k in range(1500)] + [("d", 200_000), ("d", None), (None, 5), (None, 4), (None, None), ("e", 131_072)]
    df = spark.createDataFrame(rows, "doc_id string, page_idx long")
    want = set()
    for doc in ("d", None, "e"):
        own = sorted(p for d, p in rows if d == doc and p is not None)
        want |= {(doc, p) for p in own[:n]}
    got = [tuple(r) for r in pages.first_pages(df, n, dense=False).collect()]
    assert len(got) == len(want) and set(got) == want


def test_chunks_keep_rows_of_no_document_or_position(spark):
    df = spark.createDataFrame([("d", 0), ("d", None), (None, 1)], "doc_id string, page_idx long")
    assert pages.with_chunk(df, 2).count() == 3


def test_empty_keys_are_keys(spark):
    rows = [("d", 0, "a"), ("d", 1, None), ("d", 2, ""), ("d", 3, ""), ("e", 0, ""), ("e", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id string, page_idx long, k string")
    for partitions in (1, 2, 6):
        got = {(r.doc_id, r.page_idx): r.run_start for r in runs.with_run_start(df, "k", partitions=partitions).collect()}
        assert got == {("d", 0): 0, ("d", 1): None, ("d", 2): 2, ("d", 3): 2, ("e", 0): 0, ("e", 1): 1}


def test_runs_over_far_positions_and_many_ranges(spark):
    """One run over several ranges, positions up to 2^60, a null document, a null position, and rows of no key."""
    far = 1 << 60
    rows = [("d", far + k, "a") for k in range(400)] + [("d", far + 400 + k, "b" if k % 2 else None) for k in range(20)]
    rows += [(None, k, "a") for k in range(50)] + [("e", None, "a"), ("e", 1, "a"), ("e", 2, "b")]
    df = spark.createDataFrame(rows, "doc_id string, page_idx long, k string")
    for partitions in (1, 7, 40):
        got = {(r.doc_id, r.page_idx): r.run_start for r in runs.with_run_start(df, "k", partitions=partitions).collect()}
        assert len(got) == len(rows) and all(got["d", far + k] == far for k in range(400))
        assert all(got["d", far + 400 + k] == (far + 400 + k if k % 2 else None) for k in range(20))
        assert all(got[None, k] == 0 for k in range(50)) and got["e", 1] is None and got["e", 2] == 2
    assert runs.with_run_start(df.limit(0), "k").count() == 0


def test_page_lists_of_alternating_keys_are_linear(spark):
    df = spark.range(600).select(F.lit("d").alias("doc_id"), F.col("id").alias("page_idx"),
                                 F.concat(F.lit("Firearm Reference Number (FRN): "), F.col("id") % 2 + 1).alias("text"))
    made = manifest.page_manifest(df, last_only=False)
    assert made.count() == 600 and "Join" not in plan(made).split("page_indices", 1)[0]
    assert manifest.page_manifest(df).select("page_indices").collect() is not None
    assert {tuple(r.page_indices) for r in manifest.page_manifest(df).collect()} == {(598,), (599,)}


def test_lookups_on_keys_of_several_rows(spark):
    df = search_text_of(spark.createDataFrame([("1", "red steel"), ("1", "red brass"), ("2", "red blue")], "id string, t string"), "t")
    posted = search.postings(df, "id")
    find = lambda q: sorted(r["id"] for r in search.term_lookup(posted, q, "id").collect())
    assert find("red blue") == ["2"] and find("red") == ["1", "2"] and find("steel brass") == ["1"] and find("?!") == []
    assert search.term_search(df, "?!").count() == 0
    by_row = search.postings(df.withColumn("n", F.monotonically_increasing_id()), ["id", "n"])
    assert search.term_lookup(by_row, "steel brass", ["id", "n"]).count() == 0


def test_parent_keys_are_reduced_before_the_shuffle(spark):
    parent = spark.range(1000).select((F.col("id") % 3).alias("k"))
    text_plan = plan(integrity.known_only(spark.range(10).withColumnRenamed("id", "k"), parent, "k"))
    assert "HashAggregate(keys=[_key" in text_plan


def test_first_blob_of_a_key_wins(spark):
    files = spark.createDataFrame([("/b/1.pdf", b"two"), ("/a/1.pdf", b"one"), ("/a/9.pdf", b"x")], "path string, content binary")
    known = spark.createDataFrame([("1",), ("1",)], "frn string")
    assert [tuple(r) for r in normalize.blob_rows(files, known).collect()] == [("1", "b25l")]


def test_upsert_refuses_a_key_twice(spark):
    current = with_full_text(spark.createDataFrame([("1", "a", 0)], "frn string, note_value string, bullet_index int"), TABLE_NOTE)
    twice = spark.createDataFrame([("1", "b", 0), ("1", "c", 0)], "frn string, note_value string, bullet_index int")
    with pytest.raises(ValueError, match="duplicate key"):
        normalize.upsert(current, twice, TABLE_NOTE)


def test_key_lookup_skips_files(spark, tmp_path):
    df = spark.range(0, 40_000, 1, 8).select(F.format_string("%06d", F.xxhash64("id") % 100_000 + 100_000).alias("frn"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_table(df, str(tmp_path), "keys")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ends = spark.read.parquet(f"{tmp_path}/keys").groupBy(F.input_file_name()).agg(F.min("frn").alias("a"), F.max("frn").alias("b")).orderBy("a").collect()
    assert len(ends) > 1 and all(x.b <= y.a for x, y in zip(ends, ends[1:]))


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_filter_on_a_field_parses_each_page_once(spark, sf_dir):
    out = QUERIES["indirect_values"](spark, sf_dir)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


def test_rows_with_a_value(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id int, make string")
    got = pages.with_value(df, "make")
    assert got.columns == ["id", "make"]
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (3, "")]


def test_label_lines_are_taken_apart_without_patterns(stored_pages):
    text_plan = stored_pages.transform(pages.with_fields)._jdf.queryExecution().optimizedPlan().toString()
    assert text_plan.count("regexp_replace") == 2


def test_whitespace_runs_collapse_and_single_blanks_stay(spark):
    texts = ["a b", "a  b", "a \tb", "a\t b", "a\tb", " a   b ", "\x1ca\n\nb c  ", "   ", "", "a 　"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r["x"] for r in df.select(text.collapse(F.col("s")).alias("x")).collect()]
    assert got == [" ".join(t.split()) for t in texts]
