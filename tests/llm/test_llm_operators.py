"""Each operator against a plain restatement, on odd rows, on an empty table and with clashing columns."""

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import components, documents, odd_rows, shingle_set, words
from leafmill.llm import ann, chat, decontaminate, langid, lines, lm, mixing, ngram_join, queries, toxicity, warc
from leafmill.llm.shared import components as graph_components
from leafmill.llm.words import shingles
from leafmill.llm.words import words as words_of


# 1: similarity join
def test_join_on_odd_rows(spark):
    rows = odd_rows()
    got = ngram_join.join_components(documents(spark, rows, clashing=True)).collect()
    want = components({i: t for i, t, *_ in rows if i is not None})
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(
        (i, len(shingle_set(t)), want[i][1] if i is not None else None) for i, t, *_ in rows)
    assert len({c for _, c in want.values()}) < len(want) - 5


def test_join_of_a_hot_group_and_chains(spark):
    rng = random.Random(5)
    base = ["b%d" % rng.randrange(500) for _ in range(60)]
    rows = []
    for k in range(150):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(60)] = "e%d" % rng.randrange(9999)
        rows.append((k, " ".join(text)))
    chain = ["c%d" % k for k in range(200)]
    rows += [(1000 + k, " ".join(chain[3 * k:3 * k + 80])) for k in range(40)]
    passage = " ".join("p%d" % k for k in range(55))
    rows += [(2000 + k, passage + " " + " ".join("u%d" % rng.randrange(10**6) for _ in range(100))) for k in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_components(documents(spark, rows)).collect()}
    assert got == components(dict(rows))


def test_join_when_no_star_proposes_a_pair(spark):
    passages = [" ".join("%s%d" % (name, k) for k in range(100)) for name in "pq"]
    rows = [(1, " ".join(passages))]
    rows += [(10 * (k + 1) + c, text + " " + " ".join("own%d_%d_%d" % (k, c, j) for j in range(8)))
             for k, text in enumerate(passages) for c in range(3)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_components(documents(spark, rows)).collect()}
    assert got == components(dict(rows))
    assert {c for _, c in got.values()} == {1, 10, 20}


def test_join_moves_only_what_is_compared(spark, monkeypatch):
    staged = {}

    def stage(df, name):
        staged.setdefault(name, []).append((df, kept(df, name)))
        return staged[name][-1][1]

    kept = ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", stage)
    passages = [" ".join("%s%d" % (name, k) for k in range(100)) for name in "pq"]
    rows = [(1, " ".join(passages))]
    rows += [(10 * (k + 1) + c, text + " " + " ".join("own%d_%d_%d" % (k, c, j) for j in range(8)))
             for k, text in enumerate(passages) for c in range(3)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_components(documents(spark, rows)).collect()}
    assert got == components(dict(rows))
    # prefixes are counted before nodes are joined; behind a shared shingle only the rest is kept, in halves
    assert "first(size(" not in staged["join-nodes"][0][0]._jdf.queryExecution().optimizedPlan().toString()
    for _, left in staged["join-open"]:
        assert left.schema["own"].dataType.simpleString() == "array<int>"
        assert all(v >= r.shingle >> 32 for r in left.collect() for v in r.own)


def test_join_makes_sets_in_one_worker_a_task(spark, monkeypatch):
    plans = []
    kept = ngram_join.stage

    def stage(df, name):
        if name == "join-bodies":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(ngram_join, "stage", stage)
    base = ["w%d" % k for k in range(60)]
    rows = [(k, " ".join([*base, "own%d" % k])) for k in range(6)] + [(0, "other words under an id that is held twice"), (9, "none")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_components(documents(spark, rows)).collect())
    assert got == sorted([(k, 57, 0) for k in range(6)] + [(0, 5, 0), (9, 1, 9)])
    assert plans and all(p.count("MapInArrow") == 1 for p in plans)


def test_join_hashes_a_large_batch_in_small_slices():
    rng = np.random.default_rng(7)
    texts = [" ".join(map(str, rng.integers(0, 1 << 30, 9_000))) for _ in range(80)]
    batch = pa.record_batch({"doc_id": pa.array(range(80), pa.int64()), "text": pa.array(texts)})
    counts = np.zeros(1 << ngram_join.SKETCH_BITS, np.int32)
    run = ngram_join._prepare(lambda: counts, 5, 80)
    tracemalloc.start()
    rows = sum(out.num_rows for out in run([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 80 and peak < 24 << 20


def test_join_of_texts_that_rows_without_id_repeat(spark):
    base = ["t%d" % k for k in range(60)]
    near = base[:-1] + ["other"]
    rows = [(None, " ".join(base)), (5, " ".join(base)), (None, " ".join(near)), (6, " ".join(near)), (7, "on its own")]
    got = ngram_join.join_components(documents(spark, rows).coalesce(1)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(
        [(None, 56, None)] * 2 + [(5, 56, 5), (6, 56, 5), (7, 1, 7)])


def test_join_of_nothing(spark):
    assert ngram_join.join_components(documents(spark, [])).count() == 0


def test_order_two_never_loses_a_link():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) > rng.random() * 0.2], rng.integers(0, 2**63, n // 12).astype(np.uint64))))
        if not len(b):
            continue
        same = len(np.intersect1d(a, b))
        if 100 * same >= 80 * (len(a) + len(b) - same):
            assert ngram_join._passes_second(ngram_join._second(a, 80), len(a), ngram_join._second(b, 80), len(b), 80)


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 100 + k) for k in range(1, 20)] + [(300, 300), (205, 204), (204, 205)]
    got = {r.node: r.component for r in graph_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, **{100 + k: 100 for k in range(20)}, 204: 204, 205: 204}


# 2: toxicity
def test_toxicity_held_out(spark):
    rng = random.Random(4)
    plain = ["word%d" % k for k in range(300)]
    bad = ["nasty", "vile", "grot", "blech"]
    rows, labels = [], []
    for k in range(900):
        toxic = k % 5 == 0
        text = [rng.choice(plain) for _ in range(rng.randrange(20, 80))]
        if toxic:
            for _ in range(4):
                text[rng.randrange(len(text))] = rng.choice(bad) + rng.choice(["", "ish", ",", "!"])
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    held = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1}
    train = spark.createDataFrame([x for x in labels if x[0] not in held] + [(5, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(documents(spark, rows + [(10_000, None), (10_001, "")]), train).collect()}
    assert len(got) == 902 and all(0 <= s <= 1 for s in got.values()) and got[10_000] == got[10_001] < 0.7
    right = [(got[k] >= 0.7) == bool(t) for k, t in labels if k in held]
    assert sum(right) / len(right) > 0.97


def test_lexicon_against_plain_counts(spark):
    rows = [("Bad bad thing", 1), ("bad day, thing", 1), ("bad thing", 1), ("good thing", 0), ("good day", 0), (None, 0), ("", 1)] * 2
    units, odds = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    total = Counter(t for _, t in rows)
    want = {}
    for word in ("bad", "thing", "good", "day,", "day"):
        held = [t for x, t in rows if word in (x or "").lower().split()]
        a = sum(held)
        value = math.log((a + 0.5) / (total[1] + 1)) - math.log((len(held) - a + 0.5) / (total[0] + 1))
        if a >= toxicity.LEAST_DOCS and value >= toxicity.LEAST_ODDS:
            want[int(words_of(pa.array([word]))[0][0])] = value
    assert want and {u: round(o, 9) for u, o in zip(units.tolist(), odds) if u in want} == {u: round(o, 9) for u, o in want.items()}
    good = int(words_of(pa.array(["good"]))[0][0])
    assert good not in units


def test_features_against_plain_rates():
    lexicon = words_of(pa.array(["grot"]))[0]
    second = words_of(pa.array([toxicity.SECOND_PERSON]))[0]
    texts = ["You GROT! a b c d e f g h grot?", "", "aaa b0b 77 x", None]
    got = toxicity._features(pa.array(texts), lexicon, np.array([3.5]), second)
    one = dict(zip(toxicity.FEATURES, got[0]))
    assert one["lexicon"] == 0 and one["second_person"] == pytest.approx(1 / 11) and one["exclaims"] == pytest.approx(1 / 11)
    again = dict(zip(toxicity.FEATURES, toxicity._features(pa.array(["you grot a b c d e f g h grot"]), lexicon, np.array([3.5]), second)[0]))
    assert again["lexicon"] == pytest.approx(7 / 11) and again["strong"] == pytest.approx(2 / 11) and again["highest"] == 3.5
    assert again["near_share"] == pytest.approx(1 / 2) and again["near_density"] == pytest.approx(1 / 11) and again["log_hits"] == pytest.approx(math.log(3))
    assert not got[1].any() and not got[3].any()
    third = dict(zip(toxicity.FEATURES, got[2]))
    assert third["runs"] == pytest.approx(1 / 4) and third["obfuscated"] == pytest.approx(1 / 4) and third["digits"] == pytest.approx(3 / 12)


@pytest.mark.parametrize("positives", [1, 2, 4])
def test_toxicity_of_few_labels_is_no_constant(spark, positives):
    rng = random.Random(positives)
    rows = [(k, " ".join([f"w{rng.randrange(30)}" for _ in range(30)] + ["grot!!!", "vile!!!"] * 3 * (k < 2 * positives))) for k in range(60)]
    labels = spark.createDataFrame([(k, int(k < positives)) for k in range(60) if not positives <= k < 2 * positives], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(documents(spark, rows), labels).collect()}
    assert len(set(got.values())) > 1
    if positives == 4:
        assert min(got[k] for k in range(4, 8)) > np.median([got[k] for k in range(8, 60)])


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = documents(spark, odd_rows(), clashing=True)
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.0}
    assert toxicity.score(documents(spark, []), none).count() == 0


# 3: chat formatting
def _log(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, kind string, message long, role string, text string")


def test_fold_of_streams_edits_and_regenerations(spark):
    log = _log(spark, [
        (1, 0, "message", None, "user", "hi"),
        (1, 1, "open", 7, "assistant", None), (1, 3, "delta", 7, None, "wo"), (1, 2, "delta", 7, None, "hel"),
        (1, 4, "regenerate", 7, None, None), (1, 5, "delta", 7, None, "Good "), (1, 6, "delta", 7, None, "day"),
        (1, 7, "open", 8, "user", "draft"), (1, 8, "edit", 8, None, "fin"), (1, 9, "delta", 8, None, "al"),
        (1, 10, "open", 9, "user", "gone"), (1, 11, "retract", 9, None, None),
        (2, 0, "delta", 1, None, "no role"), (None, None, "message", None, None, None)])
    got = {(r.conv_id, r.seq, r.role, r.text) for r in chat.fold(log).collect()}
    assert got == {(1, 0, "user", "hi"), (1, 1, "assistant", "Good day"), (1, 7, "user", "final"), (2, 0, "", "no role"), (None, None, "", "")}


def test_chat_round_trip_of_control_strings(spark):
    rng = random.Random(2)
    parts = ["### ", "Assistant: ", " </turn>", "\n", "\\", "#", "<", "ok", "é🙂", ": "]
    rows = [(c, t, rng.choice(["user", "assistant", "a: b", "### x"]), "".join(rng.choices(parts, k=rng.randrange(6))) or None)
            for c in range(30) for t in range(rng.randrange(1, 6))]
    log = _log(spark, [(c, t, "message", None, role, text) for c, t, role, text in rows])
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(log)).collect()}
    for c in {r[0] for r in rows}:
        own = [(role, text or "") for cc, _, role, text in rows if cc == c]
        loss = "".join(text for role, text in own if role == "assistant")
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_edge_cases(spark):
    assert chat.read_back(chat.format_chats(_log(spark, []))).count() == 0
    twice = _log(spark, [(1, 0, "message", None, "user", "same")] * 2 + [(1, 0, "message", None, "user", "x" * 200_000)])
    assert chat.read_back(chat.format_chats(twice.withColumn("place", F.lit(1)))).first().n_turns == 3
    with pytest.raises(Exception, match="unknown event kind"):
        chat.fold(_log(spark, [(1, 0, "bogus", None, "user", "x")])).collect()


def test_chat_query_folds_streamed_turns(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    turns = [(c, t, rng.choice(["user", "assistant", None]), "".join(rng.choices("ab #<\\\né🙂", k=rng.randrange(30))) or None)
             for c in range(40) for t in range(rng.randrange(1, 7))]
    turns += [(50, 0, "user", "same")] * 3 + [(50, None, "user", "no number"), (None, 1, "assistant", "no conversation")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    logs, render = [], chat.format_chats
    monkeypatch.setattr(chat, "format_chats", lambda log: logs.append(log) or render(log))
    got = queries.op3_chat_formatting(spark, str(tmp_path)).collect()
    kinds = Counter(r.kind for r in logs[0].collect())
    assert set(kinds) == set(chat.KINDS) and kinds["message"] == 1 and kinds["delta"] >= 3 * len(turns)
    probe = "\\### Assistant: </turn> ok"
    plain = _log(spark, [(c, t, "message", None, role, text) for c, t, role, text in turns + [(-7, 0, "user", probe), (-7, 1, "assistant", probe)]])
    assert Counter(got) == Counter(chat.read_back(render(plain)).collect()) and len(got) == 43


# 4: WARC
def test_warc_round_trip(spark):
    big = "<p>é copy</p>" * 200
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (9, None, big), (9, "http://dup/", big), (None, "http://n/", big),
            (3, "http://c/", None), (4, "http://d/", ""), (5, "http://e/", "short"), (6, "http://f/", "short"), (7, "http://g/", "\r\n\r\nWARC/1.1\r\n" * 100),
            (8, "http://h/", "y" * 300_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    got = warc.roundtrip(pages, payloads=True).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.page_id].append(r)
    for page, _, html in rows:
        data = (html or "").encode()
        for r in by[page]:
            assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
            assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data
    assert {p: (by[p][0].record_type, by[p][0].refers_to) for p in (1, 2, 9, None, 5, 6)} == {
        1: ("revisit", 9), 2: ("revisit", 9), 9: ("response", None), None: ("revisit", 9), 5: ("response", None), 6: ("response", None)}
    assert by[2][0].url == "http://b/%0D%0AX:%20y"
    assert warc.roundtrip(pages.limit(0)).count() == 0


def test_warc_archives_and_damage():
    records = [warc.record(k, f"http://x/{k}", (b"<html>%d the same page text" % k) * 60, None) for k in range(40)]
    data = warc.archive(records)
    assert data[:4] == b"\x5d\x2a\x4d\x18" and list(warc.frames(memoryview(data))) == records
    few = warc.archive(records[:2])
    assert few[:4] == b"\x28\xb5\x2f\xfd" and list(warc.frames(memoryview(few))) == records[:2]
    with pytest.raises(ValueError):
        list(warc.frames(memoryview(data[:-3])))
    for bad in (records[0].replace(b"WARC/1.1", b"WARC/9.9"), records[0].replace(b"page text", b"page tixt"), records[0][:-1]):
        with pytest.raises(ValueError):
            warc.parse(bad)


# 5: language model
@pytest.mark.parametrize("shard_bytes, hot_share", [(lm.SHARD_BYTES, lm.HOT_SHARE), (300, 12), (300, 1)])
def test_kneser_ney_against_plain_sums(spark, monkeypatch, shard_bytes, hot_share):
    monkeypatch.setattr(lm, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(lm, "HOT_SHARE", hot_share)
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 30))) for _ in range(60)] + [None, "", "Zz zz"]
    rows = list(enumerate(texts))
    train = documents(spark, [r for r in rows if r[0] % 4])
    folder, model = lm.train(train)
    got = {r.doc_id: r for r in lm.score(documents(spark, rows, clashing=True), folder, model).collect()}
    seqs = {i: words(t) + ["</s>"] for i, t in rows}
    pairs, tokens = Counter(), Counter()
    for i, s in seqs.items():
        if i % 4:
            tokens.update(s)
            pairs.update(zip(["<s>"] + s, s))
    assert 0 < len(model.hot) <= 2 * hot_share if hot_share > 1 else len(model.hot) == 0
    assert (model.shards > 4) == (shard_bytes == 300)
    followers, before, total = defaultdict(Counter), Counter(), Counter()
    for (u, w), c in pairs.items():
        followers[u][min(c, 3)] += 1
        before[w] += 1
        total[u] += c
    d = lm.discounts(*(sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)))
    e = lm.discounts(*(sum(c == k for c in before.values()) for k in (1, 2, 3, 4)))
    rest = sum(e[min(c, 3) - 1] for c in before.values())
    N, V, C = sum(tokens.values()), len(tokens), len(pairs)

    def low(w):
        return ((max(before[w] - e[min(before[w], 3) - 1], 0) if before[w] else 0) + rest / (V + 1)) / C

    def prob(u, w):
        if not total[u]:
            return low(w)
        c = pairs[u, w]
        gamma = sum(d[k - 1] * followers[u][k] for k in (1, 2, 3)) / total[u]
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / total[u] + gamma * low(w)

    assert abs(sum(low(w) for w in tokens) + rest / (V + 1) / C - 1) < 1e-9
    for i, s in seqs.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(s), sum(tokens[w] > 0 for w in s), N)
        assert math.isclose(r.base_score, sum(math.log10((tokens[w] + 1) / (N + V + 1)) for w in s), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(prob(u, w)) for u, w in zip(["<s>"] + s, s)), rel_tol=1e-9)


def test_followers_of_a_hot_word_are_dealt_to_all_shards(spark, monkeypatch):
    """A word is a third of all tokens, with 4,000 different followers."""
    monkeypatch.setattr(lm, "SHARD_BYTES", 8000)
    rows = [(k, " ".join("the f%d x%d" % (40 * k + j, rng) for j, rng in enumerate(random.Random(k).sample(range(10**6), 40)))) for k in range(100)]
    _, model = lm.train(documents(spark, rows))
    sizes = [size for _, size, _ in model.pairs.values()]
    assert len(model.pairs) == model.shards > 5 and max(sizes) < 2 * sum(sizes) / len(sizes)
    the = words_of(pa.array(["the"]))[0]
    assert list(model.hot_facts[np.searchsorted(model.hot, the)][0]) == [4000, 4000, 0, 0]


def test_language_model_edges(spark):
    folder, model = lm.train(documents(spark, []))
    got = lm.score(documents(spark, odd_rows(), clashing=True), folder, model).collect()
    assert len(got) == len(odd_rows()) and all(r.score == 0 == r.n_known for r in got)
    assert lm.score(documents(spark, []), *lm.train(documents(spark, odd_rows()))).count() == 0


# 6: line dedup
def _plain_clean(rows, min_chars=40, min_docs=5):
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: x.strip(strip).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(-math.inf if i is None else i)
    out = []
    for i, t in rows:
        own = -math.inf if i is None else i
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if not (len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and own < max(held[key(x)]))]
        out.append((i, "\n".join(kept), len(all_), len(all_) - len(kept)))
    return Counter(out)


def _line_rows():
    shared = "This very line is shared by many of the documents here"
    rows = [(k, f"own line {k} that is certainly long enough to count\n {shared.upper()}\t\n{shared}\nx") for k in range(6)]
    return rows + [(None, shared), (None, None), (7, ""), (8, "\n\n"), (8, "\n\n"), (9, "é" * 39), (10, ("z" * 50 + "\n") * 6),
                   *[(20 + k, "a short line") for k in range(9)]]


def test_lines_against_plain(spark):
    rows = _line_rows()
    got = lines.dedup_lines(documents(spark, rows, clashing=True)).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_lines", "n_dropped", "key")
    assert Counter(tuple(r)[:4] for r in got.collect()) == _plain_clean(rows)
    assert lines.dedup_lines(documents(spark, [])).count() == 0


def test_line_index_is_reversible(spark):
    rows = _line_rows()
    first, second = documents(spark, rows[:4]), documents(spark, rows[4:])
    index = lines.LineIndex(spark).insert(first)
    before = index.clean(first).select("doc_id", "text").collect()
    assert all(r.text == t for r, (_, t) in zip(sorted(before), sorted(rows[:4])))
    index.insert(second)
    everything = documents(spark, rows)
    got = index.clean(everything).select("doc_id", F.coalesce("text", F.lit("")), "n_lines", "n_dropped").collect()
    assert Counter(map(tuple, got)) == _plain_clean(rows)
    index.delete(second.select("doc_id"))
    assert sorted(index.clean(first).select("doc_id", "text").collect()) == sorted(before)


def test_line_index_goes_on_from_its_folder(spark, tmp_path):
    rows = _line_rows()
    first, second = documents(spark, rows[:4]), documents(spark, rows[4:])
    folder = str(tmp_path / "index")
    before = sorted(lines.LineIndex(spark, folder).insert(first).clean(first).select("doc_id", "text").collect())
    lines.LineIndex.open(spark, folder).insert(second)
    again = lines.LineIndex.open(spark, folder)
    got = again.clean(documents(spark, rows)).select("doc_id", F.coalesce("text", F.lit("")), "n_lines", "n_dropped").collect()
    assert Counter(map(tuple, got)) == _plain_clean(rows)
    again.delete(second.select("doc_id"))
    last = lines.LineIndex.open(spark, folder)
    assert last.version == 3 and sorted(last.clean(first).select("doc_id", "text").collect()) == before


@pytest.mark.parametrize("sent", [True, False])
def test_filters_keep_rare_keys_from_the_exact_table(spark, monkeypatch, sent):
    """Of 20,000 distinct keys and one common one, few but the common one's rows are looked up, by either way to the filters."""
    monkeypatch.setattr(lines, "FILTER_BYTES", (64 << 20) if sent else 0)
    shared = "this line is common to a lot of the documents"
    rows = [(d, "\n".join([shared, *(f"line {k} of document {d} is its own and long" for k in range(200))])) for d in range(100)]
    docs = documents(spark, rows).repartition(6)
    index = lines.LineIndex(spark).insert(docs)
    asked = index.maybe_common(index.entries()).collect()
    assert len(asked) < 100 + 20_000 * 0.01 and len({(r.k1, r.k2) for r in asked if sum(x.k1 == r.k1 for x in asked) >= 5}) == 1
    assert {r.doc for r in index.drops(index.entries()).collect()} == set(range(99))


def test_filters_of_many_shards(spark, monkeypatch):
    monkeypatch.setattr(lines, "KEYS_PER_SHARD", 3)
    monkeypatch.setattr(lines, "FILTER_BYTES", 0)
    rows = [(d, "\n".join(f"common line number {k} of a whole lot of documents" for k in range(d % 3, 40))) for d in range(30)]
    got = lines.dedup_lines(documents(spark, rows)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert Counter(map(tuple, got)) == _plain_clean(rows)


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 30_000).astype(np.uint64)
    own = lines.CuckooFilter.of(keys[:20_000])
    assert own.contains(keys[:20_000]).all() and own.contains(keys[20_000:]).mean() < 0.01
    own.delete(keys[:10_000])
    assert own.contains(keys[10_000:20_000]).all() and own.contains(keys[:10_000]).mean() < 0.01
    assert lines.CuckooFilter.read(own.blob()).contains(keys[10_000:20_000]).all()


# 7: language ID
def _language_rows():
    rng = random.Random(8)
    stems = {"en": "the of and ing tion whith ould", "de": "der die und schen ung ich keit", "fr": "les des eau tion aux que ment", "es": "los ción que ado mente ndo ella"}
    rows = []
    for k in range(240):
        lang = list(stems)[k % 4]
        rows.append((k, " ".join(rng.choice(stems[lang].split()) for _ in range(40)), lang, f"{lang}.example"))
    return rows


def test_language_fusion(spark):
    rows = _language_rows() + [(900, "", "de", "de.example"), (901, None, None, "fr.example"), (902, "qzxj 0912 ~~~ 中文文中" * 30, None, None),
                               (903, rows_text := "the of and ing tion " * 9, "fr", "fr.example"), (903, rows_text, "fr", "fr.example")]
    docs = documents(spark, rows)
    got = langid.identify(langid.of_documents(docs), ["doc_id"]).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and all(by[k].lang == lang and not by[k].rejected for k, _, lang, _ in rows[:240])
    assert by[900].lang == "de" and by[901].lang == "fr"            # no text: markup and host decide
    assert by[902].rejected and by[903].text_lang == "en"
    assert langid.identify(langid.of_documents(documents(spark, [])), ["doc_id"]).count() == 0


def _posteriors(rows):
    """Plain sums of the fused posterior: rows are (id, text, declared, suffix, host, site)."""
    def codes(text):
        raw = [32 if b < 33 else b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()]
        return [((a | b << 8 | c << 16) * 2654435761 % 2**32) >> 17 for a, b, c in zip(raw, raw[1:], raw[2:])]

    known, names, size = langid.LANGUAGES, (*langid.LANGUAGES, "und"), 2**15
    counts = {k: Counter() for k in known}
    for _, text, declared, *_ in rows:
        if declared in counts:
            counts[declared].update(codes(text))
    sums = {k: sum(counts[k].values()) + 0.01 * size for k in known}
    evidence = []
    for _, text, *_ in rows:
        own = codes(text)
        logs = [sum(math.log((counts[k][c] + 0.01) / sums[k]) for c in own) for k in known] + [-math.log(size) * len(own)]
        evidence.append([x / (1 + len(own) / 100) for x in logs])
    best = [e.index(max(e)) for e in evidence]
    total, everything = Counter(best), len(rows)

    def held(column):
        out = defaultdict(Counter)
        for r, b in zip(rows, best):
            out[r[column] or ""][b] += 1
        return out

    by = {c: held(c) for c in (2, 3, 4, 5)}

    def given(column, value, k):
        own = by[column][value or ""]
        return math.log((own[k] + 20 * own.total() / everything) / (total[k] + 20))

    def host(r, k):
        site, own = by[5][r[5] or ""], by[4][r[4] or ""]
        p = (site[k] + 20 * (total[k] + 1) / (everything + 5)) / (site.total() + 20)
        return math.log((own[k] + 20 * p) / (own.total() + 20))

    for r, e in zip(rows, evidence):
        logs = [e[k] + given(2, r[2], k) + given(3, r[3], k) + host(r, k) for k in range(5)]
        share = [math.exp(x - max(logs)) for x in logs]
        at = share.index(1.0)
        yield r[0], names[at], 1 / sum(share), names[e.index(max(e))], names[at] == "und" or 1 / sum(share) < 0.5


def test_language_posterior_against_plain_sums(spark):
    rng = random.Random(31)
    rows = []
    for k, text, lang, _ in _language_rows()[:120]:
        words_ = text.split()[: rng.choice((0, 1, 2, 5, 40))]
        declared = rng.choice((lang, lang, "en", "xx", None))
        host = rng.choice((f"{lang}.a.example", "b.example", None))
        site = None if host is None else ".".join(host.split(".")[-2:])
        rows.append((k, " ".join(words_).title() or None, declared, rng.choice((lang, "com", None)), host, site))
    shape = "doc_id long, text string, declared string, suffix string, host string, site string"
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, shape), ["doc_id"]).collect()}
    assert len(got) == len(rows) and len({r.lang for r in got.values()}) >= 4
    for i, lang, posterior, text_lang, rejected in _posteriors(rows):
        assert math.isclose(got[i].posterior, posterior, rel_tol=1e-3), i
        assert got[i].text_lang == text_lang and (got[i].lang, got[i].rejected) == (lang, rejected), i
    # nothing known of any text: all evidence is equal, and the language named first takes ties
    blank = spark.createDataFrame([(i, "", None, None, None, None) for i in range(5)], shape)
    assert {(r.lang, r.text_lang) for r in langid.identify(blank, ["doc_id"]).collect()} == {("en", "en")}


def test_language_of_pages(spark):
    pages = spark.createDataFrame([(1, "https://m.x.example.com/de/1?q=2", '<!DOCTYPE html><html class=a lang="de-AT"><script>var x="<p>";</script><p>Text'),
                                   (2, None, None), (3, "http://y.fr", "<HTML LANG=fr>x")], "page_id long, url string, html string")
    got = {r.page_id: r for r in langid.of_pages(pages).collect()}
    assert (got[1].declared, got[1].suffix, got[1].host, got[1].site) == ("de", "de", "m.x.example.com", "example.com")
    assert "var" not in got[1].text and "Text" in got[1].text
    assert got[2].declared is None and (got[3].declared, got[3].suffix) == ("fr", "fr")


# 8: nearest neighbours
def test_neighbours_recall_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16)).astype(np.float32) * rng.uniform(0.5, 2, (3000, 1)).astype(np.float32)
    x[1000:1600] = x[1000]                                            # one large group of equal vectors
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(x)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [1.0, None] + [0.0] * 14), (5003, [float("nan")] * 16), (5004, [float("inf")] * 16), (5005, [1.0]), (None, rows[0][1]), rows[3]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rep int")
    index = ann.build_index(df)
    got = defaultdict(list)
    for r in ann.search(index, df.where("vec_id % 50 = 0")).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 50))
    exact = x.astype(np.float64)
    hits = []
    for q, found in got.items():
        score = (exact * exact[q]).sum(1)
        score[q] = -np.inf
        want = np.lexsort((np.arange(3000), -np.round(score, 9)))[:20]
        assert [r for r, _, _ in sorted(found)] == list(range(1, 21))
        assert all(abs(score[v] - s) < 1e-9 for _, v, s in found)
        hits.append(len({v for _, v, _ in found} & set(want.tolist())) / 20)
    assert np.mean(hits) >= 0.9
    assert {v for _, v, _ in got[1000]} == set(range(1001, 1021))


def test_few_or_no_neighbours(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = ann.search(ann.build_index(df), df.where("vec_id = 1")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 0.5), (3, 0.0)]
    none = df.limit(0)
    assert ann.search(ann.build_index(none), none).count() == 0


# 9: decontamination
def _leaks(docs, items, at_least=0.8):
    sets = {i: shingle_set(t) for i, t in items if words(t)}
    held = Counter(s for own in sets.values() for s in own)
    weight = lambda s: math.log1p(len(items) / max(held[s], 1))
    out = {}
    for d, t in docs:
        w, whole = words(t), shingle_set(t)
        for i, own in sets.items():
            if not own & whole:
                continue
            n = len(words(dict(items)[i]))
            for k in range(max(0, len(w) - n + 1)):
                if n < 5 and len(w) != n:
                    continue
                mine = shingle_set(" ".join(w[k:k + n]))
                alike = sum(map(weight, mine & own)) / sum(map(weight, mine | own))
                if alike >= at_least - 1e-12:
                    out[d, i] = max(out.get((d, i), 0), alike)
    return out


def test_clean_documents_judge_rows_by_their_text(spark):
    item = " ".join(f"item{k}" for k in range(30))
    other = " ".join(f"other{k}" for k in range(30))
    docs = [(None, f"a b {item} c"), (1, item), (1, "clean words " * 9), (2, other), (None, None), (3, "")]
    bench = spark.createDataFrame([(None, other), (5, item), (5, "third " * 9), (6, None)], "item_id long, text string")
    got = decontaminate.clean_documents(documents(spark, docs, clashing=True), bench)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, docs[2][1]), (None, None), (3, "")], key=str)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(documents(spark, docs), bench).collect()} == {(None, 5), (1, 5), (2, None)}


def test_only_items_that_share_a_shingle_are_looked_at():
    texts = pa.array([" ".join(f"i{i}w{k}" for k in range(12)) + " five shared words of all" * (i < 3) for i in range(400)])
    value, _ = shingles(*words_of(texts), 5)
    index = decontaminate.ItemIndex.of(texts, 5, 400, dict.fromkeys(np.unique(value).tolist(), 1))
    own, _ = shingles(*words_of(texts.slice(7, 1)), 5)
    at, known = index.lookup(own)
    assert len(at) == len(own) and index.holders(known).tolist() == [7]
    common, _ = shingles(*words_of(pa.array(["five shared words of all"])), 5)
    assert index.holders(index.lookup(common)[1]).tolist() == [0, 1, 2]


@pytest.mark.parametrize("block_words, slice_bytes", [(decontaminate.BLOCK_WORDS, decontaminate.SLICE_BYTES), (100, 2000)])
def test_leaks_against_all_windows(spark, monkeypatch, block_words, slice_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", slice_bytes)
    rng = random.Random(9)
    vocabulary = ["v%d" % k for k in range(300)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(9, 50)))) for k in range(25)]
    items += [(50, items[3][1] + " and one more"), (51, "tiny item"), (52, None), (53, "")]
    docs = []
    for k in range(80):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        if k % 2:
            item = words(items[rng.randrange(25)][1])
            if k % 4 == 1 and len(item) > 30:
                item[rng.choice([0, 1, -1, len(item) // 2])] = "edited"
            cut = rng.randrange(len(text) + 1)
            text[cut:cut] = item
        docs.append((k, "  ".join(text).upper() if k % 3 else " ".join(text)))
    docs += [(200, None), (201, ""), (202, "Tiny item"), (203, "a tiny item here"), (204, items[0][1]), (204, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert (len(decontaminate._index_files(bench, 5)[1]) > 4) == (block_words == 100)
    found = decontaminate.find_leaks(documents(spark, docs, clashing=True), bench)
    got = found.collect()
    # the documents are scanned once, whatever the number of blocks
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    want = _leaks(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(want) > 30 and (202, 51) in want and (203, 51) not in want
    assert sum(r.doc_id == 204 and r.item_id == 0 for r in got) == 2


def test_leaks_of_items_with_runs_of_one_word(spark):
    rng = random.Random(19)
    items, docs = [], []
    for k in range(12):
        item = ["i%d_%d" % (k, j) for j in range((49, 14)[k % 2])] + ["run%d" % k] * 24
        items.append((k, " ".join(item)))
        around = [["a%d" % rng.randrange(10**6) for _ in range(rng.randrange(1, 40))] for _ in range(2)]
        docs.append((k, " ".join(around[0] + item + around[1])))
        docs.append((100 + k, " ".join(around[1] + item[:3] + ["edited"] + item[4:] + ["run%d" % k] * 50 + around[0])))
    got = decontaminate.find_leaks(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in _leaks(docs, items).items()}
    assert {r.doc_id for r in got if r.similarity == 1.0 and r.doc_id == r.item_id} == set(range(12))


def test_leaks_in_documents_shorter_than_the_item(spark):
    items = [(k, " ".join("i%d_%d" % (k, j) for j in range(size))) for k, size in enumerate((100, 100, 30, 4, 7))]
    docs = []
    for k, text in items:
        item = words(text)
        for cut in (item[:-1], item[1:], item[:-3], item[2:-2], item[: len(item) // 2] + item[len(item) // 2 + 1:], item[: len(item) // 2], item):
            docs.append((len(docs), " ".join(cut)))
    got = decontaminate.find_leaks(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    # each shingle is in one item, so all weigh the same
    want = {}
    for d, text in docs:
        for i, item in items:
            a, b = shingle_set(text), shingle_set(item)
            if len(a & b) >= 0.8 * len(a | b):
                want[d, i] = (round(len(a & b) / len(a | b), 9), 0, len(words(text)))
    assert {(r.doc_id, r.item_id): (round(r.similarity, 9), r.first_word, r.n_words) for r in got} == want
    assert want[0, 0] == (round(95 / 96, 9), 0, 99) and len(want) > 12


def test_no_items_no_leaks(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    odd = documents(spark, odd_rows())
    assert decontaminate.find_leaks(odd, none).count() == 0
    assert decontaminate.clean_documents(odd, none).count() == len(odd_rows())
    some = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert decontaminate.find_leaks(documents(spark, []), some).count() == 0


# 10: mixing
def test_mix_reaches_targets(spark):
    rng = random.Random(10)
    rows = [(k, " ".join("w" for _ in range(rng.randrange(0, 900))), "en", rng.choice(["a", "a", "a", "a", "b", "é", None])) for k in range(400)]
    rows += [(7, "twice the same", "en", "a")] * 2 + [(None, "no id", "en", "b"), (900, None, "en", "empty"), (901, "w " * 5000, "en", "b")]
    got = mixing.mix(documents(spark, rows, clashing=True)).taken.collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, len(words(t))) for i, t, _, s in rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    targets, left = {}, 1.5 * sum(sizes.values())
    rest = dict(weights)
    while True:
        level = left / sum(rest.values())
        full = [s for s in rest if level * rest[s] > 2 * sizes[s]]
        if not full:
            break
        for s in full:
            targets[s] = 2.0 * sizes[s]
            left -= targets[s]
            del rest[s]
    targets |= {s: level * w for s, w in rest.items()}
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6 and r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    again = mixing.mix(documents(spark, list(reversed(rows)))).taken.collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in got)
    assert mixing.mix(documents(spark, [])).taken.count() == 0


def test_mix_is_even_along_the_schedule(spark):
    targets = spark.createDataFrame([("0a", 50_000, 3.0, 60_000.0), ("0b", 90_000, 1.0, 20_000.0), ("1", 70_000, 2.0, 40_000.0)],
                                    "key string, source_size long, weight double, target double")
    slots = mixing.slot_schedule(targets, 64).orderBy("place").collect()
    seen, n = Counter(), 0
    for slot in slots:
        seen[slot.key] += 1
        n += 1
        assert abs(seen["0a"] - n / 2) < 12 and abs(seen["0b"] - n / 6) < 12
    for key, target in (("0a", 60_000), ("0b", 20_000), ("1", 40_000)):
        own = [s for s in slots if s.key == key]
        assert sum(s.words for s in own) == target
        assert [(s.epoch, s.block) for s in own] == sorted((s.epoch, s.block) for s in own)
