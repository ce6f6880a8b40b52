"""Merges by key and postings in step, against plain Python."""

import random

import pytest

from leafmill.functions.search import search_text_of
from leafmill.operators import search
from leafmill.sources.keyed import KeyedTable, PostingIndex

SCHEMA = "frn string, pos int, value string"


def frame(spark, rows):
    return spark.createDataFrame([(*k, v) for k, v in rows.items()], SCHEMA)


def stored(table):
    rows = [((r.frn, r.pos), r.value) for r in table.rows().collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_merges_rewrite_touched_buckets_only(spark, tmp_path):
    rng = random.Random(2)
    folder = str(tmp_path / "table")
    # one parent has most of the rows, and its rows lie in many buckets
    want = {(f"k{i % 30}" if i % 3 else "hot", i): f"v{i}" for i in range(900)}
    table = KeyedTable.create(spark, folder, frame(spark, want), ["frn", "pos"], buckets=12)
    assert len(table.parts) == 12 and stored(table) == want
    for turn in range(3):
        keys = rng.sample(sorted(want), 3)
        changes = {k: f"changed {turn}" for k in keys[:2]} | {("new", turn): "added"}
        deleted = [keys[2], keys[0], ("absent", 1)]
        before = dict(table.parts)
        table = KeyedTable.open(spark, folder).merge(frame(spark, changes), spark.createDataFrame(deleted, "frn string, pos long"))
        want.pop(keys[2])
        want |= changes
        assert stored(table) == want and stored(KeyedTable.open(spark, folder)) == want
        same = [b for b in before if table.parts.get(b) == before[b]]
        assert len(same) >= 12 - 5 and table.version == turn + 1
    assert len(stored(KeyedTable.open(spark, folder, version=0))) == 900


def test_merge_edges(spark, tmp_path):
    folder = str(tmp_path / "table")
    table = KeyedTable.create(spark, folder, frame(spark, {("a", 1): "x"}), ["frn", "pos"], buckets=3)
    assert table.merge() is table
    gone = table.merge(deleted=spark.createDataFrame([("a", 1)], "frn string, pos int"))
    assert stored(gone) == {} and stored(gone.merge(frame(spark, {("b", 2): "y"}))) == {("b", 2): "y"}
    with pytest.raises(ValueError):
        gone.merge(spark.createDataFrame([("c", 1, "x"), ("c", 1, "y")], SCHEMA))
    with pytest.raises(ValueError):
        KeyedTable.create(spark, str(tmp_path / "twice"), spark.createDataFrame([("c", 1, "x")] * 2, SCHEMA), ["frn", "pos"])
    none = KeyedTable.create(spark, str(tmp_path / "none"), frame(spark, {}), ["frn", "pos"])
    assert stored(none) == {} and stored(none.merge(frame(spark, {("b", 2): "y"}))) == {("b", 2): "y"}


def test_postings_follow_changes(spark, tmp_path):
    rng = random.Random(4)
    words = ["red", "green", "blue", "redder", "under"]
    want = {("k", i): " ".join(rng.choices(words, k=3)) for i in range(60)}

    def texts(rows):
        return search_text_of(frame(spark, rows), "value")

    def check(index):
        for lookup, term, holds in ((search.term_lookup, "red", lambda v: "red" in v.split()), (search.term_lookup, "green blue", lambda v: {"green", "blue"} <= set(v.split())),
                                    (search.prefix_lookup, "red", lambda v: any(w.startswith("red") for w in v.split())),
                                    (search.suffix_lookup, "der", lambda v: any(w.endswith("der") for w in v.split()))):
            got = [tuple(r) for r in lookup(index.live(), term, ["frn", "pos"]).collect()]
            assert sorted(got) == sorted(k for k, v in want.items() if holds(v))

    folder = str(tmp_path / "index")
    index = PostingIndex.create(spark, folder, texts(want), ["frn", "pos"])
    check(index)
    for turn in range(3):
        changes = {("k", i): " ".join(rng.choices(words, k=2)) for i in rng.sample(range(70), 8)}
        deleted = [k for k in rng.sample(sorted(want), 5) if k not in changes]
        index = PostingIndex.open(spark, folder).apply(texts(changes), spark.createDataFrame(deleted, "frn string, pos int"))
        want = {k: v for k, v in want.items() if k not in deleted} | changes
        check(index)
        if turn == 1:
            index = index.compact()
            assert not index.parts and not index.gone
            check(index)
    plan = search.term_lookup(index.live(), "red", ["frn", "pos"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(token,red)") >= 1 or plan.count("In(token") >= 1


def test_text_of_changes_only(spark, tmp_path):
    rows = spark.createDataFrame([("1", "make", 0, "Old; value", "kept as it was"), ("1", "make", 1, "b", "as well")],
                                 "frn string, note_key string, bullet_index int, note_value string, fullText string")
    table = KeyedTable.create(spark, str(tmp_path / "notes"), rows, ["frn", "note_key", "bullet_index"], buckets=2)
    changed = rows.where("bullet_index = 1").replace("b", "New; one", "note_value")
    got = {r.bullet_index: (r.note_value, r.fullText) for r in table.merge(changed, text_of="dbo_frnNote").rows().collect()}
    assert got == {0: ("Old; value", "kept as it was"), 1: ("New; one", "New one 1 1 eno weN")}
