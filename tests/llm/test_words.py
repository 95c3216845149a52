import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from staylens.llm.textbatch import windows, words_of
from tests_llm_helpers import words


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZé漢 -0_\n 🙂", max_size=40)), max_size=8))
def test_words_and_windows(texts):
    found = words_of(pa.array(texts, pa.string()))
    want = [words(t) for t in texts]
    got = [found.text(k).decode() for k in range(len(found.start))]
    assert got == [w for row in want for w in row]
    assert np.diff(found.first).tolist() == [len(w) for w in want]
    hashes, slot = windows(found, 3)
    grams = [[tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else [] for w in want]
    assert np.diff(slot).tolist() == [len(g) for g in grams]
    by = {}
    for h, g in zip(hashes.tolist(), [g for row in grams for g in row], strict=True):
        assert by.setdefault(g, h) == h
    assert len(set(by.values())) == len(by)
