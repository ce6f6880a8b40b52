"""Files, layouts, appends and posting blocks, against plain Python."""

import random

import pyarrow.parquet as pq
import pytest

from leafmill.functions.search import search_text_of
from leafmill.operators import blocks, search
from leafmill.sources.blobs import list_files, read_blobs, read_files, write_files
from leafmill.sources.keyed import KeyedTable
from leafmill.sources.tables import write_table


def test_files_written_listed_and_read(spark, tmp_path):
    folder = str(tmp_path / "files")
    content = {"a/1 +é%.pdf": b"\x00\xff", "a/2.pdf": b"", "b/1 +é%.pdf": b"later", "b/c/3.pdf": None, "b/4.txt": b"no"}
    rows = spark.createDataFrame([(k, None if v is None else bytearray(v)) for k, v in content.items()], "name string, content binary")
    assert write_files(rows, folder) == 5 and write_files(rows.limit(0), folder) == 0
    files = {r.path.split("/files/")[1]: (r.length, bytes(r.content)) for r in read_files(spark, folder, recursive=True).collect()}
    assert files == {k: (len(v or b""), v or b"") for k, v in content.items() if k.endswith(".pdf")}
    listed = [r.path.split("/files/")[1] for r in list_files(spark, folder, recursive=True).collect()]
    assert listed == sorted(files)
    assert {r.frn: r.pdf64 for r in read_blobs(spark, folder, recursive=True).collect()} == {"1 +é%": "AP8=", "2": "", "3": ""}
    # writing again replaces, one folder is read without the folders in it, and a pattern that meets nothing gives no rows
    assert write_files(rows, folder) == 5
    assert [r.frn for r in list_files(spark, folder + "/a").collect()] == ["1 +é%", "2"]
    assert read_files(spark, folder, "*.gif", recursive=True).count() == 0


def test_layout_of_several_columns(spark, tmp_path):
    rng = random.Random(4)
    data = [(f"k{rng.randrange(400):03}", rng.choice("abcd"), rng.randrange(1000) if i % 50 else None) for i in range(6000)]
    rows = spark.createDataFrame(data, "frn string, kind string, size int")
    write_table(rows, str(tmp_path), "t", cluster=("frn", "kind", "size"), files=32)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(map(str, map(tuple, stored.collect()))) == sorted(map(str, data))
    ends = {"frn": [], "kind": [], "size": []}
    for file in (tmp_path / "t").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for i in range(meta.num_columns):
            s = meta.row_group(0).column(i).statistics
            ends[meta.schema.column(i).name].append((s.min, s.max))
    for column, value, most in (("frn", "k123", 0.6), ("kind", "b", 0.6), ("size", 777, 0.6)):
        meet = [e for e in ends[column] if e[0] is not None and e[0] <= value <= e[1]]
        assert 0 < len(meet) <= most * len(ends[column]), column
    write_table(rows.limit(0), str(tmp_path), "none", cluster=("frn", "kind"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_appends_refuse_stored_keys(spark, tmp_path):
    schema = "frn string, pos int, value string"
    folder = str(tmp_path / "table")
    first = [(f"k{i % 9}", i, "old") for i in range(300)]
    table = KeyedTable.create(spark, folder, spark.createDataFrame(first, schema), ["frn", "pos"], buckets=10)
    before = {b: list(p) for b, p in table.parts.items()}
    new = [("k1", 1000, "new"), ("x", 1, "new")]
    more = table.append(spark.createDataFrame(new, schema))
    assert sorted(map(tuple, more.rows().collect())) == sorted(first + new)
    assert all(more.parts[b][:len(p)] == p for b, p in before.items())                 # no file was rewritten
    assert sum(len(p) for p in more.parts.values()) <= 12
    for bad in ([("y", 1, "v"), ("k3", 3, "again")], [("y", 1, "v"), ("y", 1, "w")], [("k1", 1000, "v")], [(None, 5, "v")]):
        with pytest.raises(ValueError):
            more.append(spark.createDataFrame(bad, schema))
    assert KeyedTable.open(spark, folder).version == more.version == 1
    assert more.append(spark.createDataFrame([], schema)) is more
    # only row groups between the new keys are read
    plan = more._near(spark.createDataFrame([("k3", 3, ""), ("k4", 5, "")], schema), {0, 1})._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(frn,k3), LessThanOrEqual(frn,k4)" in plan and "ReadSchema: struct<frn:string,pos:int>" in plan   # the plan's text is cut after these
    merged = more.merge(spark.createDataFrame([("k1", 1000, "merged")], schema))
    assert sorted(map(tuple, merged.rows().collect())) == sorted(first + [("k1", 1000, "merged"), ("x", 1, "new")])


def test_replaced_parents(spark, tmp_path):
    schema = "frn string, pos int, value string"
    first = [("hot", i, "old") for i in range(200)] + [(f"k{i}", i, "old") for i in range(20)]
    table = KeyedTable.create(spark, str(tmp_path / "table"), spark.createDataFrame(first, schema), ["frn", "pos"], buckets=40)
    before = dict(table.parts)
    table = table.replace(spark.createDataFrame([("k3", 7, "new"), ("none", 1, "new")], schema), ["frn"])
    want = [r for r in first if r[0] != "k3"] + [("k3", 7, "new"), ("none", 1, "new")]
    assert sorted(map(tuple, table.rows().collect())) == sorted(want)
    assert sum(table.parts.get(b) == p for b, p in before.items()) >= len(before) - 3
    table = table.replace(spark.createDataFrame([("hot", 1, "new")], schema), ["frn"])
    assert sorted(map(tuple, table.rows().collect())) == sorted([r for r in want if r[0] != "hot"] + [("hot", 1, "new")])


def test_blocks_follow_the_rarest_term(spark, tmp_path):
    rng = random.Random(8)
    rows = {i: {"all"} | {f"w{rng.randrange(40)}" for _ in range(3)} | ({"rare"} if i in (17, 2500) else set()) for i in range(4000)}
    text = search_text_of(spark.createDataFrame([(i, " ".join(sorted(t))) for i, t in rows.items()], "id long, text string"), "text")
    posted = search.postings(text, "id", mirrored=False).union(search.postings(text.limit(50), "id", mirrored=False))
    made = blocks.posting_blocks(posted, "id", block=50)
    blocks.write_blocks(made, str(tmp_path / "blocks"))
    stored = spark.read.parquet(str(tmp_path / "blocks"))
    sizes = {(r.token, r.block): (r.n, len(r.entries)) for r in stored.collect()}
    assert max(n for n, _ in sizes.values()) <= 50 and all(n == m for n, m in sizes.values())
    assert sum(n for n, _ in sizes.values()) == sum(map(len, rows.values()))
    for query in ("all", "rare all", "all w3", "w1, W2; all", "rare w1", "all absent", "", "w5 w5"):
        terms = set(search.query_terms(query))
        want = sorted(i for i, t in rows.items() if terms and terms <= t)
        assert sorted(r.id for r in blocks.block_lookup(stored, query, "id").collect()) == want, query
    heads = stored.where("token = 'all'")
    rare = spark.createDataFrame([(17,), (2500,)], "id long")
    asked = blocks.blocks_asked(heads, rare, "id", heads.count())
    assert heads.count() >= 80 and 1 <= asked.count() <= 2
    assert blocks.block_lookup(stored.where("false"), "all", "id").count() == 0
