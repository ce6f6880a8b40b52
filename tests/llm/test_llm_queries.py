"""Registered queries: SQL twins where there are some, brute force or held-out quality where not."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from brute import components
from leafmill.llm import ann
from leafmill.llm.oracles import ORACLES
from leafmill.llm.queries import QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(duck, sql):
    return duck.execute(sql).fetchall()


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries()) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    assert Counter(tuple(r[c] for c in order) for r in df.collect()) == Counter(
        tuple(r[columns.index(c)] for c in order) for r in result.fetchall())


def test_join(spark, duck, sf_dir):
    want = components(dict(rows(duck, "SELECT doc_id, text FROM documents")))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_ngram_jaccard_join"](spark, sf_dir).collect()}
    assert got == want


def test_language_model_beats_its_base(spark, sf_dir):
    got = QUERIES["op5_kneser_ney"](spark, sf_dir).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_id_agrees_with_declarations(spark, duck, sf_dir):
    got = QUERIES["op7_language_id"](spark, sf_dir).collect()
    lang = dict(rows(duck, "SELECT doc_id, lang FROM documents"))
    own = [r for r in got if r.doc_id is not None]
    assert len(own) == len(lang) and len(got) == len(lang) + rows(duck, "SELECT count(*) FROM pages")[0][0]
    assert np.mean([r.lang == lang[r.doc_id] for r in own]) > 0.98 and np.mean([r.rejected for r in own]) < 0.02


def test_neighbours_recall(spark, duck, sf_dir):
    table = rows(duck, "SELECT vec_id, embedding FROM embeddings ORDER BY vec_id")
    ids, x = np.array([i for i, _ in table]), np.array([v for _, v in table], float)
    found = {}
    for r in QUERIES["op8_permutation_index"](spark, sf_dir).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    share = []
    for at in np.flatnonzero(ids % 20 == 0):
        score = (x * x[at]).sum(1)
        score[at] = -np.inf
        share.append(len(found[ids[at]] & set(ids[np.lexsort((ids, -score))[:20]].tolist())) / 20)
    assert np.mean(share) >= 0.9


def test_neighbours_recall_with_few_candidates(spark, duck, sf_dir, monkeypatch):
    monkeypatch.setattr(ann, "CANDIDATES", 20)
    table = rows(duck, "SELECT vec_id, embedding FROM embeddings ORDER BY vec_id")
    assert ann.SHARE * len(table) < len(table) / 2
    found = {}
    for r in QUERIES["op8_permutation_index"](spark, sf_dir).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    ids, x = np.array([i for i, _ in table]), np.array([v for _, v in table], float)
    share = []
    for at in np.flatnonzero(ids % 20 == 0):
        score = (x * x[at]).sum(1)
        score[at] = -np.inf
        share.append(len(found[ids[at]] & set(ids[np.lexsort((ids, -score))[:20]].tolist())) / 20)
    assert np.mean(share) >= 0.9


def test_pipeline_stages(spark, duck, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination",
                                                      "mixing sources to target weights"]
    from test_llm_operators import _leaks, _plain_clean
    steps = [f for _, f in corpus_pipeline.STAGES]
    one = steps[0](spark, docs, sf_dir).cache()
    assert one.columns == docs.columns and one.count() >= 0.98 * docs.count()
    two = steps[1](spark, one, sf_dir).cache()
    plain = _plain_clean([(r.doc_id, r.text) for r in one.collect()])
    assert Counter((r.doc_id, r.text) for r in two.collect()) == Counter({(k[0], k[1]): v for k, v in plain.items()})
    assert two.columns == docs.columns
    three = steps[2](spark, two, sf_dir).cache()
    want = components({r.doc_id: r.text for r in two.collect()})
    assert {r.doc_id for r in three.collect()} == {i for i, (_, least) in want.items() if i == least}
    four = steps[3](spark, three, sf_dir).cache()
    items = rows(duck, "SELECT item_id, text FROM benchmark")
    leaks = {d for d, _ in _leaks([(r.doc_id, r.text) for r in three.collect()], items)}
    assert {r.doc_id for r in four.collect()} == {r.doc_id for r in three.collect()} - leaks and four.columns == docs.columns
    five = steps[4](spark, four, sf_dir).collect()
    total = Counter()
    for r in five:
        total[r.source] += r.taken
        assert r.taken <= 2 * r.size
    assert all(abs(total[r.source] - r.target) <= 1 for r in five) and len(five) == four.count()


def test_toxicity_learns_from_few_labels(spark, duck, sf_dir):
    """52 labels to learn from, 6 of them toxic: no constant, and better than chance on those held out."""
    toxic = dict(rows(duck, "SELECT doc_id, max(toxic) FROM labels GROUP BY doc_id"))
    got = QUERIES["op2_toxicity"](spark, sf_dir).collect()
    assert len({r.score for r in got}) > 20 and all(r.predicted == int(r.score >= 0.7) for r in got)
    held = [(r.score, toxic[r.doc_id]) for r in got if r.held_out and r.doc_id in toxic]
    pairs = [(a > b) + (a == b) / 2 for a, x in held if x == 1 for b, y in held if y == 0]
    assert np.mean(pairs) > 0.6
