"""Quality rules, conversation repair and whitening against brute force, and on odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafmill.llm import dialogue, quality, queries, whitening

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_quality(rows):
    """rows (doc_id, host, text) -> verdicts in the same order."""
    hosts, held, own = defaultdict(set), defaultdict(set), []
    for doc, host, text in rows:
        host, text = host or "", text or ""
        lines = [" ".join(WORD.findall(line)) for line in text.split("\n")]
        lines = ["".join(c.lower() if c.isascii() else c for c in line) for line in lines if line]
        hosts[host].add(doc)
        for line in lines:
            held[host, line].add(doc)
        own.append((host, lines))
    out = []
    for (doc, _, text), (host, lines) in zip(rows, own):
        text = text or ""
        words = WORD.findall(text)
        at = defaultdict(list)
        for i in range(len(words) - 4):
            at[tuple(words[i: i + 5])].append(i)
        covered = {i + j for places in at.values() if len(places) > 1 for i in places for j in range(5)}
        raw = [line for line in text.split("\n") if WORD.search(line)]
        removed = sum(len(line.split(" ")) for line in lines
                      if len(held[host, line]) > 5 and 100 * len(held[host, line]) > len(hosts[host]))
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        left = len(words) - removed
        out.append((doc, len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(raw) - len(set(raw)), len(covered),
                    failed, removed, not failed and left >= 10 and 100 * left >= 30 * len(words)))
    return out


ODD_TEXTS = [None, "", " \n\t\r\n ", "a", "w " * 30_000, "x" * 300_000, "\n".join(f"line {i} of many words here" for i in range(3000)),
             "Same Line\nsame line\nSame Line\n  same  LINE ", "é ü # * $ %\x0b& | < >\n\n\nend"]


def quality_frame(spark, rows):
    return spark.createDataFrame([(d, t, h, "en") for d, h, t in rows], "doc_id long, text string, source string, _row string")


def test_quality_rules(spark):
    rng = random.Random(3)
    shared = [" ".join(f"s{k}w{j}" for j in range(rng.randint(1, 15))) for k in range(12)]
    rows = [(None if i % 97 == 0 else i // 2 if i < 20 else i, rng.choice(["a", "a", "b", None]), "\n".join(
        (line.upper() if rng.random() < 0.3 else line) + ("  " if rng.random() < 0.2 else "")
        for line in [*rng.sample(shared, rng.randint(0, 4)), *(" ".join(f"u{i}x{rng.randint(0, 40)}" for _ in range(rng.randint(0, 12))) for _ in range(4))]))
        for i in range(300)]
    rows += [(1000 + i, "odd", text) for i, text in enumerate(ODD_TEXTS)]
    got = quality.quality(quality_frame(spark, rows).repartition(5)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept").collect()
    want = brute_quality(rows)
    assert Counter(map(tuple, got)) == Counter(want) and 20 < sum(w[-1] for w in want) < 300 and any(w[-2] for w in want)


def test_quality_of_hot_lines(spark):
    """A line that all of a large host's documents hold is counted and removed like any other."""
    rows = [(i, "big" if i % 3 else f"h{i}", "boilerplate of all these pages\n" + " ".join(f"w{i}n{j}" for j in range(20))) for i in range(2500)]
    got = quality.quality(quality_frame(spark, rows)).collect()
    assert all(r.n_removed_words == (5 if r.host == "big" else 0) and r.kept for r in got) and len(got) == 2500


def test_clean_texts(spark):
    line = "this line is on every page of it"
    rows = [(i, "h", f"{line}\n" + " ".join(f"w{i}n{j}" for j in range(20)) + f"\n {line.upper()}") for i in range(10)]
    rows += [(20 + i, "h", f"{line}\nshort {i}") for i in range(3)] + [(30, "h", None)]
    got = quality.clean(quality_frame(spark, rows)).collect()
    assert {(r.doc_id, r.source, r._row) for r in got} == {(i, "h", "en") for i in range(10)}
    assert all(r.text == " ".join(f"w{r.doc_id}n{j}" for j in range(20)) for r in got)


def test_quality_of_nothing(spark):
    empty = quality_frame(spark, [])
    assert quality.quality(empty).count() == 0 and quality.clean(empty).columns == empty.columns and quality.clean(empty).count() == 0


# conversations

def brute_audit(rows):
    """(cost, audit) by the cheapest path over all edit strings: rows are (initial, gone, truncated)."""
    best = {}

    def after(state, initial):
        return {("start", "s"): "s", ("start", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    for i in range(len(rows), -1, -1):
        own = {q: (0, "") if i == len(rows) and q in ("start", "a") else (10 ** 9, "") for q in ("start", "s", "u", "a")}
        if i < len(rows):
            initial, gone, cut = rows[i]
            for q in own:
                own[q] = min(own[q], (best[q][0] + 4, "D" + best[q][1]))
                if not gone:
                    to = after(q, initial)
                    if to:
                        own[q] = min(own[q], (best[to][0] + 3 * cut, "K" + best[to][1]))
                    for said in "ua":
                        to = after(q, said)
                        if to:
                            own[q] = min(own[q], (best[to][0] + 3 + 3 * cut, "R" + best[to][1]))
        for _ in range(5):
            for q in own:
                for said in "ua":
                    to = after(q, said)
                    if to:
                        own[q] = min(own[q], (own[to][0] + 3, "I" + own[to][1]))
        best = own
    return best["start"]


def signature(rows):
    return "".join(chr(65 + 4 * "suax".index(i) + (2 if gone else int(cut))) for i, gone, cut in rows)


TURN = st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(TURN, max_size=9), min_size=1, max_size=6))
def test_automaton(conversations):
    table = str.maketrans(dialogue._SYMBOLS, dialogue._MERGED)
    automaton = dialogue.SuffixAutomaton()
    ordered = sorted(conversations, key=lambda c: signature(c).translate(table)[::-1])
    for c in ordered:
        assert automaton.read(signature(c).translate(table)[::-1].encode()) == brute_audit(c)
    suffixes = {signature(c).translate(table)[i:] for c in conversations for i in range(len(c))}
    assert automaton.made == len(suffixes)


def brute_repair(rows):
    """Undamaged rows (conv, turn, role, text) of one conversation: gaps, faults, cost, audit and digest."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for _, t, r, x in rows),
                  key=lambda y: (y[0] is not None, y[0] or 0, y[1], hashlib.sha256(y[2].encode()).digest()))
    seen, marks, counts = set(), [], Counter()
    for _, role, text in rows:
        ink = re.sub("[\x20\x09-\x0d]", "", text)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        marks.append((role[0] if role[:1] in ("s", "u", "a") else "x", fault in ("blank", "duplicate"), fault == "truncated"))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = brute_audit(marks)
    out, at, last = [], 0, ""
    for edit in audit:
        says = "assistant" if last == "u" else "user"
        if edit == "I":
            out.append((says, ""))
        else:
            if edit != "D":
                out.append((rows[at][1] if edit == "K" else says, rows[at][2]))
            at += 1
        last = out[-1][0][0] if out else ""
    sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha


def test_repair_of_odd_conversations(spark):
    rng = random.Random(8)
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None], ["Yes.", "yes", "No!", "ok?", "", " \t", None, "so.\n", "é…", "x" * 100_000 + "."]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for _ in range(500)]
    rows += [(70, t, ("user", "assistant")[t % 2], "Same.") for t in range(400)] + [(71, 3, "user", "Hi.")] * 300
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, conv string")
    ids = spark.createDataFrame([(c,) for c in {r[0] for r in rows} | {99}], "conv_id long")
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.digests(frame.repartition(4), ids).collect()}
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    want = {c: brute_repair(own) for c, own in groups.items()}
    want[99] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got == want


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "assistant", "Well"), (2, 0, "tool", "x.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, dialogue.repaired(frame, dialogue.audits(frame)).collect()))
    assert got == [("1", 0, "user", "Hi.", "K"), ("1", 1, "assistant", "", "I"), ("1", 2, "user", "Again.", "K"), ("1", 3, "assistant", "Well", "K")]
    none = frame.limit(0)
    assert dialogue.digests(none, none.select("conv_id")).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in (None, 0, 1)]
    got = Counter((r.role, r.text) for r in queries.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    assert set(got) == {("assistant", "One. Two! Three?"), ("assistant", ""), ("assistant", "One Two Three"), ("user", "One. Two! Three?")}


# whitening

def brute_whitening(vectors):
    """x, n * x - S as exact numbers, eigenvalues and vectors in falling order."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    centred = [[n * a - s for a, s in zip(row, sums)] for row in x]
    d = len(sums)
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n ** 3)) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    return centred, values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize("d, n", [(6, 200), (40, 90), (5, 4)])
def test_whitening(spark, d, n):
    rng = np.random.default_rng(d)
    vectors = (rng.standard_normal((n, d)) * np.linspace(1, 9, d) + 3).round(3).tolist()
    odd = [(-1, None), (-2, []), (-3, [None] * d), (-4, [float("nan")] * d), (-5, [float("inf")] * d), (-6, [1.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in [*enumerate(vectors), *odd]], "vec_id long, embedding array<double>, x string")
    got = whitening.whiten(whitening.grid(frame)).collect()
    centred, values, basis = brute_whitening(vectors)
    k = min(32, d, n - 1)
    assert len(got) == n * k and {r.n for r in got} == {n}
    table = np.zeros((n, k))
    for r in got:
        table[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == sum(c * c for c in centred[r.vec_id])
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
    want = (np.array(centred, float) / n) @ basis[:, :k] / np.sqrt(values[:k])
    assert np.abs(np.abs(table) - np.abs(want)).max() < 1e-6
    error = np.abs(table.T @ table / n - np.eye(k)).max()
    assert {r.identity_error for r in got} == {got[0].identity_error} and abs(got[0].identity_error - error) < 1e-9 > error


def test_whitening_of_large_entries(spark):
    """Sums stay exact far beyond what floating-point numbers hold; a deviation that no long holds is null."""
    vectors = [[1e9 * i, 1e9 * (i % 3) + 1 / 64, float(i)] for i in range(30)]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    centred, values, _ = brute_whitening(vectors)
    for r in whitening.whiten(whitening.grid(frame)).collect():
        exact = sum(c * c for c in centred[r.vec_id])
        assert r.deviation == (exact if exact < 1 << 63 else None)
    huge = spark.createDataFrame([(i, [3e38 * (-1) ** i, 1.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(whitening.grid(huge)).count() == 5


def test_whitening_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])]):
        got = whitening.whiten(whitening.grid(spark.createDataFrame(rows, schema)))
        assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    two = whitening.whiten(whitening.grid(spark.createDataFrame([(None, [1.0, 2.0]), (3, [2.0, 2.0])], schema))).collect()
    assert {(r.vec_id, r.component, round(abs(r.whitened), 9)) for r in two} == {(None, 1, 1.0), (3, 1, 1.0)}


def test_spectrum_slicing():
    rng = np.random.default_rng(5)
    for values in ([5, 5, 5, 2, 2, 1, 0, 0], [5, 5 + 1e-9, 5 - 1e-12, 2, 2, 1, 1e-9, 0], [3] * 6, [7], [1e-3, 1e6, 1], np.linspace(1, 1.001, 50)):
        q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
        v = q @ np.diag(np.array(values, float)) @ q.T
        v = (v + v.T) / 2
        e, u = whitening.eigenpairs(v)
        want = [x for x in sorted(np.linalg.eigvalsh(v), reverse=True) if x > 1e-10 * max(values)][:32]
        assert len(e) == len(want) and np.allclose(e, want, atol=1e-13 * max(values) * len(v), rtol=0)
        assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13 and np.abs(v @ u - u * e).max() < 1e-13 * max(values) * len(v)


def test_inertia_counts():
    rng = np.random.default_rng(6)
    for _ in range(300):
        d = int(rng.integers(1, 12))
        a = rng.integers(-3, 4, (d, d))
        a, shift = (a + a.T).astype(float), float(rng.normal())
        assert whitening.count_above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()


def test_whitening_does_not_shuffle_rows(spark, sf_dir):
    rows = whitening.grid(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    plan = whitening.whiten(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert rows.agg(F.count("*")).first()[0] > 0
