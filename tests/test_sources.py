"""Files in and out."""

import base64
import json

import pyarrow as pa
import pytest

from leafmill.operators import integrity, normalize
from leafmill.operators.assemble import records
from leafmill.plans.flow import run_flow
from leafmill.plans.render import rendered_pages
from leafmill.session import settle
from leafmill.sources import jsontext
from leafmill.sources.blobs import list_files, read_blobs
from leafmill.sources.pages import read_paged_text, read_pages
from leafmill.sources.records import read_records, write_record_array, write_record_arrays, write_records
from leafmill.sources.tables import read_table, write_tables
from leafmill.spec import TABLE_BLOB, TABLE_NOTE, TABLE_RECORD

RECORDS = [
    {"frn": "1", "make": "Ünï", "notes": {"zeta": ["a", "b"], "alpha": ["c"]},
     "sub_entries": [{"frn": "1-1", "shots": "5", "barrel_length": "100"}]},
    {"frn": "", "make": "skipped"},
    {"make": "skipped too"},
    {"frn": "2", "model": 7, "cross_references": [{"frn": "9", "description": "x"}]},
]


@pytest.fixture
def folder(tmp_path):
    sub = tmp_path / "with blank"
    sub.mkdir()
    return sub


def check(spark, folder):
    made = normalize.tables(read_records(spark, str(folder)))
    rows = {r["frn"]: r for r in made[TABLE_RECORD].collect()}
    assert set(rows) == {"1", "2"}
    assert (rows["1"]["make"], rows["1"]["model"], rows["2"]["model"]) == ("Ünï", "", "7")
    notes = sorted((r["note_key"], r["bullet_index"], r["note_value"]) for r in made[TABLE_NOTE].collect())
    assert notes == [("alpha", 0, "c"), ("zeta", 0, "a"), ("zeta", 1, "b")]


def test_pretty_array(spark, folder):
    (folder / "a.json").write_text(json.dumps(RECORDS, indent=2, ensure_ascii=False), encoding="utf-8")
    check(spark, folder)


def test_lines(spark, folder):
    text = "\n\n".join(json.dumps(r, ensure_ascii=False) for r in RECORDS)
    (folder / "a.jsonl").write_text(text, encoding="utf-8")
    check(spark, folder)


def test_array_and_lines_together(spark, folder):
    (folder / "a.json").write_text(json.dumps(RECORDS[:1], indent=2, ensure_ascii=False), encoding="utf-8")
    (folder / "b.jsonl").write_text("\n".join(map(json.dumps, RECORDS[1:])), encoding="utf-8")
    check(spark, folder)


def test_leading_blank_means_lines(spark, folder):
    (folder / "a.json").write_text("\n" + json.dumps(RECORDS[0], ensure_ascii=False) + "\n"
                                   + json.dumps(RECORDS[3]), encoding="utf-8")
    check(spark, folder)


def test_broken_line_fails(spark, folder):
    (folder / "a.jsonl").write_text('{"frn": "1"}\n{"frn": \n', encoding="utf-8")
    with pytest.raises(Exception):
        read_records(spark, str(folder)).collect()


ODD = [{"a": 'brace } and { in "quotes" \\', "b": {"c": [1, {"d": "]["}]}}, {}, {"e": "\\\\"}, {"é}": "ü\n}" * 40, "f": [[], {}]}, {"g": "x" * 500}]


@pytest.fixture
def tiny_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "211")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("layout", ["pretty", "one line", "lines", "lines end", "spaced"])
def test_objects_over_many_splits(spark, folder, tiny_splits, layout):
    """Strings and objects cross splits of 211 bytes; every object comes out whole, once."""
    objects = ODD * 5
    text = {"pretty": json.dumps(objects, indent=3, ensure_ascii=False), "one line": json.dumps(objects),
            "lines": "\n".join(json.dumps(o) for o in objects), "lines end": "\n".join(json.dumps(o) for o in objects) + "\n",
            "spaced": "\n [ " + " , ".join(json.dumps(o) for o in objects) + " ]\n\n"}[layout]
    (folder / "a.json").write_text(text, encoding="utf-8")
    (folder / "b.json").write_text("[]", encoding="utf-8")
    (folder / "c.json").write_text(json.dumps([{"other": 1}]), encoding="utf-8")
    states = jsontext.split_states(spark, str(folder)).collect()
    assert len(states) > 12 and any(r.in_string for r in states)
    got = [json.loads(r.value) for r in jsontext.json_objects(spark, str(folder)).collect()]
    key = lambda o: json.dumps(o, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, [*objects, {"other": 1}]))


def test_one_array_over_part_files(spark, tmp_path, sf_dir, request):
    made = settle(records(rendered_pages(spark, sf_dir)).limit(40))
    write_record_array(made, str(tmp_path / "parts"), files=4)
    files = sorted(p for p in (tmp_path / "parts").iterdir() if p.name.startswith("part-"))
    whole = json.loads("".join(p.read_text(encoding="utf-8") for p in files))
    assert len(files) > 1 and len(whole) == 40
    order = [r.frn for r in made.orderBy("doc_id", "first_page_idx").collect()]
    assert [r.get("frn") for r in whole] == order
    write_records(made, str(tmp_path / "lines"))
    write_record_arrays(made, str(tmp_path / "arrays"), files=3)
    for p in (tmp_path / "arrays").iterdir():
        if p.name.startswith("part-"):
            assert isinstance(json.loads(p.read_text(encoding="utf-8") or "[]"), list)
    want = sorted(map(str, read_records(spark, str(tmp_path / "lines"), "lines").collect()))
    request.getfixturevalue("tiny_splits")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    assert sorted(map(str, read_records(spark, str(tmp_path / "parts"), "parts").collect())) == want
    assert sorted(map(str, read_records(spark, str(tmp_path / "arrays")).collect())) == want
    assert sorted(map(str, read_records(spark, str(tmp_path / "lines")).collect())) == want
    assert len(jsontext.split_states(spark, str(tmp_path / "parts"), concatenated=True).collect()) > len(files)


def test_array_of_nothing(spark, tmp_path, sf_dir):
    write_record_array(records(rendered_pages(spark, sf_dir)).limit(0), str(tmp_path / "none"))
    assert read_records(spark, str(tmp_path / "none"), "parts").count() == 0


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": "1}]', '{"a": [}', "[{}]]"])
def test_incomplete_texts_fail(spark, folder, text):
    (folder / "a.json").write_text(text)
    with pytest.raises(Exception):
        read_records(spark, str(folder)).collect()


def test_note_order_is_kept(spark, folder):
    (folder / "a.jsonl").write_text(json.dumps(RECORDS[0]), encoding="utf-8")
    (row,) = read_records(spark, str(folder)).collect()
    assert [n["note_key"] for n in row["notes"]] == ["zeta", "alpha"]


def test_written_records(spark, sf_dir, tmp_path):
    out = tmp_path / "out"
    write_records(records(rendered_pages(spark, sf_dir)), str(out))
    lines = [json.loads(line) for f in sorted(out.glob("part-*")) for line in f.read_text().splitlines()]
    assert len(lines) == 1500
    assert all(v not in (None, [], {}) for r in lines for v in r.values())
    # vol-a comes before vol-b, keys ascend inside a volume
    volume_a = [int(r["frn"]) for r in lines if int(r["frn"]) % 3]
    volume_b = [int(r["frn"]) for r in lines if int(r["frn"]) % 3 == 0]
    assert [int(r["frn"]) for r in lines] == sorted(volume_a) + sorted(volume_b)
    two = next(r for r in lines if r["frn"] == "4")
    assert list(two["notes"]) == ["make", "legalLawComments"]
    assert set(two["cross_references"][0]) == {"frn", "description"}


def test_blobs(spark, folder):
    content = bytes(range(256))
    (folder / "12.pdf").write_bytes(content)
    (folder / "9.v2.pdf").write_bytes(b"x")
    (folder / "x.txt").write_bytes(b"no")
    got = {r["frn"]: r["pdf64"] for r in read_blobs(spark, str(folder)).collect()}
    assert got == {"12": base64.b64encode(content).decode(), "9.v2": "eA=="}
    listed = [(r["frn"], r["length"]) for r in list_files(spark, str(folder)).collect()]
    assert listed == [("12", 256), ("9.v2", 1)]
    parent = spark.createDataFrame([("12",)], "frn string")
    blobs = read_blobs(spark, str(folder))
    assert [r["frn"] for r in integrity.known_only(blobs, parent, "frn").collect()] == ["12"]
    assert integrity.blob_report(blobs, parent).collect()[0].asDict() == {"n_loaded": 1, "n_repeated": 0, "n_skipped": 1}


def test_paged_text_in_splits(spark, folder):
    expected = {}
    for name, n in (("one", 3), ("two", 400), ("three", 1)):
        texts = [f"{name} page {i}\nline é" * (i % 3) for i in range(n)]
        (folder / f"{name}.txt").write_text("\f".join(texts) + ("\f" if n == 3 else ""), encoding="utf-8")
        expected.update({(name, i): t for i, t in enumerate(texts) if t})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        out = read_paged_text(spark, str(folder))
        assert out.rdd.getNumPartitions() >= 1
        got = {(r["doc_id"], r["page_idx"]): r["text"] for r in out.collect() if r["text"]}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == expected


def test_flow(spark, sf_dir, tmp_path):
    pages_path = str(tmp_path / "pages")
    rendered_pages(spark, sf_dir).write.parquet(pages_path)
    files = spark.createDataFrame(
        [("/x/1.pdf", bytearray(b"a")), ("/x/none.pdf", bytearray(b"b"))], "path string, content binary")
    out = str(tmp_path / "out")
    result = run_flow(spark, read_pages(spark, pages_path), out, blobs=files, strict=True)
    counts = {r["table_name"]: r["n_rows"] for r in result.load_report.collect()}
    assert counts == {"dbo_frn": 1500, "dbo_frnSubEntry": 2250, "dbo_frnNote": 2773,
                      "dbo_frnCrossReference": 1500, "dbo_frnPdf": 1}
    counted = integrity.load_report(result.tables).collect()
    assert {tuple(r) for r in counted} == set(counts.items())
    facts = spark.read.parquet(out + "/stage/page_facts")
    keys = spark.createDataFrame([("1",), ("none",)], "frn string")
    assert {tuple(r) for r in result.report.collect()} == {
        tuple(r) for r in integrity.flow_report(facts, result.records, keys).collect()}
    assert result.violations.count() == 0
    assert result.manifest.count() == 1500
    numbered = run_flow(spark, read_pages(spark, pages_path), str(tmp_path / "ids"), row_ids=True,
                        json_records=False, group_pages=False)
    notes = numbered.tables[TABLE_NOTE]
    assert set(notes.columns) == {*result.tables[TABLE_NOTE].columns, "id"}
    assert sorted(r["id"] for r in notes.collect()) == list(range(1, 2774))
    assert numbered.manifest is None
    grouped = spark.read.parquet(f"{out}/key_pages")
    assert grouped.count() == 2249
    again = write_tables({TABLE_BLOB: result.tables[TABLE_BLOB].limit(0)}, out + "/second")
    assert again is None and read_table(spark, out + "/second", TABLE_BLOB).count() == 0
    with pytest.raises(ValueError):
        run_flow(spark, read_pages(spark, pages_path), str(tmp_path / "runs"), mode="runs", strict=True)


def test_array_files_are_scanned_once_for_their_states(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": "}\\"{"}, {"b": [1]}]')
    states = jsontext.split_states(spark, str(tmp_path))
    assert [tuple(r) for r in states.select("in_string", "depth", "base").collect()] == [(False, 0, 1)]
    assert "MapInArrow" not in states._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("low,high", [(0, 5), (1, 4), (2, 3), (4, 5)])
def test_pieces_are_joined_from_their_buffers(low, high):
    pieces = ["skipped", "{\"é\":1", "", "世{", "", "x"]
    column = pa.array(pieces)[1:]
    assert jsontext._texts(column, low, high).tobytes().decode() == "".join(p + "}" for p in pieces[1:][low:high])
