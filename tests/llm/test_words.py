import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelmart.llm import words as W

LOWER = {i: i + 32 for i in range(65, 91)}
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\n\t.Ü日", max_size=30)), max_size=8)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def grams(text, n):
    w = split(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


@given(texts)
@settings(max_examples=200, deadline=None)
def test_words_are_found_and_equal_words_hash_alike(rows):
    codes = {}
    for first, end, data, offsets in W.runs(pa.array(rows, pa.string()), 16):
        starts, ends, first_word = W.word_spans(data, offsets)
        hashes = W.word_hashes(data, starts, ends)
        for k, row in enumerate(rows[first:end]):
            own = hashes[first_word[k] : first_word[k + 1]].tolist()
            assert len(own) == len(split(row))
            for word, code in zip(split(row), own, strict=True):
                assert codes.setdefault(word, code) == code
    assert len(set(codes.values())) == len(codes)


@given(texts, st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_shingle_sets(rows, n):
    codes = {}
    seen = 0
    for first, end, hashes, bounds in W.shingle_sets(pa.array(rows, pa.string()), n):
        for k in range(end - first):
            own = hashes[bounds[k] : bounds[k + 1]]
            assert (np.diff(own.astype(object)) > 0).all()
            key = frozenset(grams(rows[first + k], n))
            assert len(own) == len(key)
            assert codes.setdefault(key, own.tolist()) == own.tolist()
            seen += 1
    assert seen == len(rows)


def test_a_sliced_column_and_a_text_longer_than_a_run():
    column = pa.array(["x y", None, "a " * 2000, "b"]).slice(1)
    got = [(first, end, len(bounds)) for first, end, _, bounds in W.shingle_sets(column, 2)]
    assert got[0][0] == 0 and got[-1][1] == 3


def test_order_with_equal_upper_bits():
    row, hashes = np.array([0, 0, 0, 0]), np.array([5, 4, 5, 4], np.uint64)
    order = W._by_row_and_hash(row, hashes, 1 << 20)
    assert hashes[order].tolist() == [4, 4, 5, 5]
