import random

import numpy as np
import pytest

from staylens.llm import sentencepiece_viterbi as op
from tests_llm_helpers import EDGES, frame


@pytest.fixture(scope="module")
def lexicon():
    return op.Lexicon.read()


def ids(raw):
    return np.frombuffer(raw, dtype="<i4").tolist()


def brute(marked, lexicon):
    """Best score and ids over all segmentations, ties to the longer last piece."""
    best = {0: (0.0, [])}
    for end in range(1, len(marked) + 1):
        for begin in range(max(0, end - lexicon.longest), end):
            piece = marked[begin:end]
            if piece in lexicon.score:
                s, i = lexicon.score[piece]
                made = [i]
            elif len(piece) == 1:
                s, made = lexicon.unknown, lexicon.bytes_of(piece)
            else:
                continue
            if end not in best or best[begin][0] + s > best[end][0]:
                best[end] = best[begin][0] + s, best[begin][1] + made
    return best[len(marked)][1]


def test_stream_and_side_by_side_agree_with_brute_force(lexicon):
    random.seed(3)
    parts = ["the", " ", "  ", "ing", "\n", "é", "漢", "🙂", "<s>", "<0x41>", "0", "\x00", "aaaa", "tion", "Haus"]
    for _ in range(400):
        text = "".join(random.choice(parts) for _ in range(random.randint(1, 12)))
        marked = op.MARK + text.replace(" ", op.MARK)
        want = brute(marked, lexicon)
        assert list(op.stream(marked, lexicon)) == want
        assert ids(op.encode_texts([text], lexicon, {})[0]) == want


def test_long_run_commits_on_the_way(lexicon):
    made = op.stream((c for c in "ab" * 20_000), lexicon)
    first = [next(made) for _ in range(10)]
    assert b"".join(lexicon.out[i] for i in [*first, *made]) == b"ab" * 20_000


def test_round_trip_and_edges(spark):
    docs = EDGES + [(30, "▁ mark ▁▁ inside"), (31, "  two  spaces  "), (32, "x" * 70_000)]
    rows = op.encode(frame(spark, docs), keep=["doc_id", "text"]).collect()
    assert len(rows) == len(docs) and all(r.exact for r in rows)
    assert all(r.n_chars == len(r.text or "") and r.n_ids == len(r.ids) for r in rows)
    lexicon = op.Lexicon.read()
    assert all(op.decode_ids(r.ids, lexicon).decode() == (r.text or "") for r in rows)
    assert op.encode(frame(spark, [])).count() == 0


def test_small_memory_gives_the_same(lexicon, monkeypatch):
    texts = ["some words here", "other words there", "some words here"]
    want = op.encode_texts(texts, lexicon, {})
    monkeypatch.setattr(op, "REMEMBERED", 2)
    known = {}
    assert [op.encode_texts([t], lexicon, known)[0] for t in texts] == want
