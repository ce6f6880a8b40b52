import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import shingle_set, words as plain_words
from leafmill.llm.words import shingles, slices, words

TEXT = st.text(alphabet="aAbBzZ é ß \t\n\x0b\x0c\r🙂0.", max_size=120)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_same_words_same_hashes(texts):
    hashes, begin = words(pa.array(texts, pa.string()))
    want = [plain_words(t) for t in texts]
    assert np.diff(begin).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    names = {}
    for word, value in zip(flat, hashes.tolist()):
        assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


def test_slices_offsets_and_long_words():
    rng = random.Random(1)
    texts = [None, "", "x" * 5000 + " " + "x" * 4999 + "y", "X" * 5000] + [" ".join("abc"[:rng.randrange(1, 4)] for _ in range(50)) for _ in range(40)]
    batch = pa.record_batch({"text": pa.array(texts, pa.string())}).slice(1)
    whole, begin = words(batch.column("text"))
    parts = [words(p.column("text")) for p in slices(batch, "text", 300)]
    assert np.concatenate([p[0] for p in parts]).tolist() == whole.tolist()
    assert len(begin) == batch.num_rows + 1
    assert whole[begin[1]] == whole[begin[2]] and whole[begin[1]] != whole[begin[1] + 1]


def test_prefixes():
    whole, _, heads = words(pa.array(["Stupid stupid, stup x"]), (4, 6))
    assert heads[0].tolist() == heads[1].tolist() and whole[0] != whole[1]
    assert heads[2, 0] == heads[0, 0] and heads[2, 1] == 0 and heads[3].tolist() == [0, 0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from("abc"), max_size=12).map(" ".join)), max_size=5))
def test_shingles(texts):
    value, bounds = shingles(*words(pa.array(texts, pa.string())))
    for i, t in enumerate(texts):
        assert len(set(value[bounds[i]:bounds[i + 1]].tolist())) == len(shingle_set(t))
