"""Plain restatements of the operators' results, and odd tables, for the tests of this folder."""

import itertools
import re

from pyspark.sql import types as T

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
CLASHING = ("key", "size", "node", "block", "shingle", "component", "n_lines", "label", "features", "declared", "k1", "a", "b")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def shingle_set(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(rows, percent=80):
    """{doc_id: (set size, smallest reachable id)} for {doc_id: text}."""
    sets = {i: shingle_set(t) for i, t in rows.items()}
    parent = {i: i for i in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(sorted(rows), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in rows}


def documents(spark, rows, clashing=False):
    """Rows (doc_id, text[, lang, source]) as documents, optionally with columns of clashing names."""
    full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s0")), len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashing:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit("x") for c in CLASHING})
    return df


def odd_rows(seed=3):
    """Nulls, empty and blank texts, ties, repeated rows, short texts, near copies and one long text."""
    import random
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    near = []
    for k in range(12):
        copy = list(base)
        for _ in range(k % 4):
            copy[rng.randrange(len(copy))] = "edit%d" % rng.randrange(1000)
        near.append(" ".join(copy))
    rows = [(None, None), (None, "a b c d e f"), (1, None), (2, ""), (3, " \t\n\x0b"), (4, "One Two"), (5, "one two"), (6, "one\ntwo three"),
            (7, "é ü ß x y z"), (8, "!!! ??? ***"), (9, "no source", None, None), (9, "no source", None, None)]
    rows += [(20 + k, t, "en", "s%d" % (k % 3)) for k, t in enumerate(near)]
    rows += [(40 + k, " ".join(rng.choice(vocabulary) for _ in range(60)) + "\n" + "a line that very many of the documents do share " * (k % 2), "de", "s1")
             for k in range(12)]
    rows += [(90, " ".join(rng.choice(vocabulary) for _ in range(30_000)), "fr", "s2"), (91, "x" * 300_000, "fr", "s2")]
    return rows
