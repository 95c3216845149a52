import random
import zlib

import numpy as np
import pytest

from staylens.llm import toxicity as op
from tests_llm_helpers import EDGES, frame

SYLLABLES = ["an", "re", "ti", "on", "el", "mo", "sa", "du", "vi", "ka", "per", "lin"]
BAD = ["grobnak", "zulfid", "wertzog"]


def texts(n, seed):
    random.seed(seed)
    rows = []
    for i in range(n):
        w = ["".join(random.choices(SYLLABLES, k=random.randint(1, 4))) for _ in range(random.randint(20, 60))]
        toxic = i % 4 == 0
        if toxic:
            w.insert(random.randrange(len(w)), random.choice(BAD) + random.choice(["", "en", "ti"]))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy_and_edges(spark):
    rows = texts(600, 5)
    docs = frame(spark, [(i, t) for i, t, _ in rows] + [(-1 - k, t) for k, (_, t) in enumerate(EDGES)])
    labels = frame(spark, [(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in op.annotate(docs, op.train(docs, labels)).select(
        "doc_id", op.held_out("doc_id").alias("held_out"), "toxicity.*").collect()}
    assert len(got) == len(rows) + len(EDGES)
    assert all(r.held_out == held(i) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    test = [(got[i].predicted, y) for i, _, y in rows if held(i)]
    assert sum(p == y for p, y in test) >= 0.97 * len(test)
    assert all(got[-1 - k].predicted == 0 for k in range(len(EDGES)))


def test_inserted_and_spaced_letters():
    model = op.fit([(op.words(t), y) for _, t, y in texts(600, 7)])
    top = lambda t: max(model.values(sorted(op.words(t))))
    plain = top("anreti onelmo")
    for written in ("grobnak", "g.r.o.b.n.a.k", "g r o b n a k", "grobxnak", "grob-nak"):
        assert top(written) > plain + 0.5, written


def test_kernel_value_is_the_sum_over_shared_subsequences():
    found = ["abcab", "aabbccdd", "xyz", "hello"]
    s, word = op.stretches(found)
    number, weight = op.features(s)
    for i in range(len(s)):
        phi = {}
        for u, w in zip(number[i].tolist(), (weight[i] * op.norms(s)[i]).tolist(), strict=True):
            if u:
                phi[u] = phi.get(u, 0) + w
        assert np.isclose(sum(v * v for v in phi.values()), op.norms(s)[i] ** 2, rtol=1e-4)


@pytest.mark.parametrize("rows", [[], [(1, 0), (3, 0)], [(2, None)]])
def test_too_few_labels_give_one_score(spark, rows):
    docs = frame(spark, EDGES)
    model = op.train(docs, frame(spark, rows, "doc_id long, toxic int"))
    made = op.annotate(docs, model, keep=["doc_id"]).select("toxicity.score").distinct().collect()
    assert len(made) == 1 and 0 <= made[0].score <= 1
    assert op.clean(docs.limit(0), frame(spark, rows, "doc_id long, toxic int")).count() == 0


def test_rejected_documents_go(spark):
    rows = texts(400, 9)
    docs = frame(spark, [(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, toxicity double")
    kept = op.clean(docs, frame(spark, [(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert kept.columns == docs.columns
    stay, toxic = {r.doc_id for r in kept.collect()}, {i for i, _, y in rows if y}
    assert len(stay & toxic) <= 0.03 * len(toxic) and len({i for i, _, y in rows if not y} - stay) <= 6


def test_very_long_words_are_read_in_linear_time(spark):
    import time
    start = time.time()
    for text in ("x" * 1_000_000, "ab-" * 300_000, "a b " * 200_000):
        op.words(text)
    assert time.time() - start < 20
    rows = texts(400, 9)
    model = op.train(frame(spark, [(i, t) for i, t, _ in rows]), frame(spark, [(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    long = [(1, "Qk9y" * 250_000), (2, "x" * 1_000_000 + " " + BAD[0]), (3, "ab-" * 300_000)]
    got = {r.doc_id: r.predicted for r in op.annotate(frame(spark, long), model).select("doc_id", "toxicity.*").collect()}
    assert got[2] == 1 and len(got) == 3
