import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tabspark.llm import text as X

PATTERN = re.compile("[0-9a-z\u0080-\U0010ffff]+")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abC é,.9 \n漢", max_size=40)), max_size=8))
def test_words(texts):
    w = X.Words(pa.array(texts, pa.string()))
    seen = {}
    for i, t in enumerate(texts):
        own = range(w.first[i], w.first[i + 1])
        assert [w.text(j) for j in own] == PATTERN.findall((t or "").lower())
        for j in own:
            assert seen.setdefault(w.text(j), w.hash[j]) == w.hash[j]
    assert len(set(seen.values())) == len(seen)


def test_long_words_and_spans():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 300_000).astype(np.uint8)
    data[100_000:] = data[:200_000].copy()
    start, end = np.array([0, 65_530, 10, 100_010, 5]), np.array([150_000, 65_540, 90_000, 190_000, 5])
    h = X.span_hashes(data, start, end)
    assert h[2] == h[3] and len(set(h.tolist())) == 4
    words = X.Words(pa.array(["x" * 200_000 + " y", "x" * 200_000, "x" * 200_001]))
    assert words.hash[0] == words.hash[2] != words.hash[3]


def test_shingles():
    w = X.Words(pa.array(["a b c d e f", "", "a b", None, "b c d e f", "a b c"]))
    h, row, first = X.shingles(w)
    assert np.diff(first).tolist() == [2, 0, 1, 0, 1, 1] and row.tolist() == [0, 0, 2, 4, 5]
    assert h[1] == h[3] and len(set(h.tolist())) == 4
