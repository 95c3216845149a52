import numpy as np
import pytest

from staylens.llm import decontaminate as op
from tests_llm_helpers import EDGES, frame, sha, words

ITEMS = [(1, "The quick brown fox jumps over the lazy dog and runs far away from here today"), (12, "short item"),
         (3, None), (4, "!!"), (12, "short item"), (5, "a a a a a a a a a a a a a a a")]
DOCS = EDGES + [
    (20, "x the QUICK brown fox jumps over the lazy dog and runs far away z"), (21, "a " * 14), (22, "a " * 12),
    (23, "a short item, a short-item short ITEM"), (24, "the quick brown fox jumps over the lazy dog and runs far way"),
    (25, ("filler word " * 200) + "short item"), (26, "from here today the quick brown fox")]


def brute(text):
    w, hit, items = words(text), set(), set()
    for item, t in ITEMS:
        v = words(t)
        n = min(13, len(v))
        for s in {tuple(v[i:i + n]) for i in range(max(1, len(v) - 12))} if v else ():
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) == s:
                    hit.update(range(i, i + n))
                    items.add(str(item))
    return len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block", [op.BLOCK_BYTES, 40])
def test_same_as_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK_BYTES", block)
    made = op.annotate(frame(spark, DOCS), frame(spark, ITEMS, "item_id long, text string"), keep=["doc_id", "text"])
    rows = made.collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        c = r.contamination
        assert (c.n_words, c.n_hit, c.n_items, c.items_sha256, c.contaminated) == brute(r.text), r.text[:60]
        assert sum(s.end_word - s.first_word for s in c.spans) == c.n_hit


def test_empty_tables_and_clashing_names(spark):
    docs = frame(spark, [(1, "short item", "x"), (2, "clean", "y")], "doc_id long, text string, contamination string")
    none = frame(spark, [], "item_id long, text string")
    assert op.clean(docs, none).count() == 2
    kept = op.clean(docs, frame(spark, ITEMS, "item_id long, text string"))
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]
    assert op.clean(docs.limit(0), none).count() == 0


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(0)
    for top in (1, 2, 9):
        text, run = rng.integers(1, top + 1, 400), np.repeat(np.arange(8), 50)
        index = op.FMIndex(text, run, top)
        phrases = np.array([np.pad(text[i:i + n], (0, 5 - n)) for i in range(0, 395, 7) for n in (1, 3, 5)])
        length = np.tile([1, 3, 5], len(phrases) // 3)
        phrase, at = index.search(phrases, length)
        want = {(p, i) for p in range(len(phrases)) for i in range(400)
                if i + length[p] <= 400 and run[i] == run[i + length[p] - 1]
                and (text[i:i + length[p]] == phrases[p, :length[p]]).all()}
        assert set(zip(phrase.tolist(), at.tolist(), strict=True)) == want and len(at) == len(want)
