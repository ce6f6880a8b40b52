"""What a whole load leaves on disk, and what it holds there meanwhile."""

import glob
import json
import os

import pytest

from leafmill import session
from leafmill.operators import assemble, manifest, normalize, pages
from leafmill.plans import flow
from leafmill.plans.flow import run_flow
from leafmill.sources.records import read_records, write_records
from leafmill.sources.tables import read_table, write_table
from leafmill.spec import SEARCH_COLUMNS

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
HEAD = "Firearm Reference Number (FRN): "


@pytest.fixture(scope="module")
def page_rows(spark):
    """Keys 1 to 40 on two pages each, in two documents; key 7 comes back later, so that it has two runs."""
    rows = []
    for k in range(1, 41):
        doc = f"d{k % 2}"
        rows.append((doc, 8 * k, f"{HEAD}{k}\nMake: Maker é {k}\nCalibre, Shots and Barrel Length\n{k} - 1 22 5 100 Antique\n"))
        rows.append((doc, 8 * k + 1, f"{HEAD}{k}\nAction: second\nNotes\nMake - marked\n- bullet of {k}\nCross-References\n{k + 1}  other\n"))
    rows.append(("d1", 8 * 99, f"{HEAD}7\nMake: again\n"))
    rows.append(("d0", 8 * 100, None))
    return session.settle(spark.createDataFrame(rows, "doc_id string, page_idx long, text string"), "page-rows")


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


@pytest.mark.parametrize("mode", ["runs", "global"])
def test_no_step_finds_the_shuffle_files_of_an_earlier_one(spark, page_rows, tmp_path, monkeypatch, mode):
    before, held = shuffle_files(spark), []

    def stage(df, path):
        held.append(len(shuffle_files(spark) - before))
        return write(df, path)

    write = flow.stage
    monkeypatch.setattr(flow, "stage", stage)
    files = spark.createDataFrame([("/x/1.pdf", bytearray(b"a")), ("/y/1.pdf", bytearray(b"b"))], "path string, content binary")
    run_flow(spark, page_rows, str(tmp_path), mode=mode, blobs=files)
    assert len(held) == 5 and not any(held)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FREED) == "false"


def test_setting_comes_back(spark):
    for own in ("true", "false"):
        spark.conf.set(FREED, own)
        try:
            with pytest.raises(KeyError), session.freed_shuffles(spark):
                assert spark.conf.get(FREED) == "true"
                raise KeyError
            assert spark.conf.get(FREED) == own
        finally:
            spark.conf.unset(FREED)


def test_records_are_compressed_and_whole(spark, page_rows, tmp_path):
    result = run_flow(spark, page_rows, str(tmp_path / "flow"), mode="runs")
    written = str(tmp_path / "flow/records_json")
    assert {f.split(".", 1)[1] for f in os.listdir(written) if f.startswith("part-")} == {"json.gz"}
    write_records(result.records, str(tmp_path / "plain"))
    want = sorted(map(str, read_records(spark, str(tmp_path / "plain"), "lines").collect()))
    assert len(want) == result.records.count() == 41
    for layout in ("lines", "auto"):
        assert sorted(map(str, read_records(spark, written, layout).collect())) == want
    run_flow(spark, page_rows, str(tmp_path / "again"), group_pages=False, json_compression=None)
    plain = [json.loads(line) for f in sorted((tmp_path / "again/records_json").glob("part-*.json")) for line in f.read_text().splitlines()]
    assert len(plain) == 40


def test_pages_of_runs_are_staged_between_their_shuffles(spark, page_rows, monkeypatch):
    settled = []

    def settle(df, *name):
        settled.append(name)
        return session.settle(df, *name)

    extracts = session.settle(pages.page_extract(page_rows))
    want = sorted(map(str, assemble.assemble(extracts, "runs").collect()))
    monkeypatch.setattr(assemble, "settle", settle)
    assert sorted(map(str, assemble.assemble(extracts, "runs", staged=True).collect())) == want
    assert settled == [("run-pages",)]


def test_stored_tables_are_compressed_well(spark, page_rows, tmp_path):
    run_flow(spark, page_rows, str(tmp_path))
    found = glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
    assert found and all(f.endswith(".zstd.parquet") for f in found)


@pytest.mark.parametrize("row_ids", [False, True])
def test_search_text_is_made_behind_the_shuffle(spark, page_rows, tmp_path, monkeypatch, row_ids):
    dealt = []
    deal = type(page_rows).repartitionByRange

    def repartition_by_range(self, *args):
        dealt.append(self.columns)
        return deal(self, *args)

    monkeypatch.setattr(type(page_rows), "repartitionByRange", repartition_by_range)
    result = run_flow(spark, page_rows, str(tmp_path), group_pages=False, json_records=False, row_ids=row_ids)
    assert len(dealt) >= 4 and not any("fullText" in columns for columns in dealt)
    monkeypatch.undo()
    wanted = normalize.tables(result.records)
    for name in SEARCH_COLUMNS:
        got = result.tables[name].drop("id")
        assert got.columns == wanted[name].columns and got.columns[-1] == "fullText"
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted[name].collect()))


def test_bloom_filters_are_as_large_as_their_values(spark, tmp_path):
    rows = spark.range(400).selectExpr("cast(id as string) frn", "concat('maker ', id) make", "concat('by ', id) manufacturer")
    write_table(rows, str(tmp_path), "dbo_frn", files=1)
    (file,) = glob.glob(f"{tmp_path}/dbo_frn/*.parquet")
    assert os.path.getsize(file) < 1_000_000
    stored = read_table(spark, str(tmp_path), "dbo_frn")
    assert [r["frn"] for r in stored.where("make = 'maker 77'").collect()] == ["77"]
    assert stored.where("make = 'maker 400'").count() == 0


def test_run_ranges_hold_document_and_key_once(spark, page_rows, monkeypatch):
    from leafmill.operators import runs

    settled = []

    def settle(df, *name):
        settled.append(df.columns)
        return session.settle(df, *name)

    monkeypatch.setattr(runs, "settle", settle)
    found = manifest.page_runs(manifest.run_parts(manifest.keyed_positions(page_rows), partitions=3))
    got = sorted((r.doc_id, r.run_start, r.frn, r.run_end, r.n_pages) for r in found.collect())
    want = [(f"d{k % 2}", 8 * k, str(k), 8 * k + 1, 2) for k in range(1, 41)]
    assert got == sorted([*want, ("d1", 792, "7", 792, 1)])
    assert settled == [["doc_id", "page_idx", "frn", "_mid", "_block", "_no", "_begin"]]
