import collections
import random

import pytest

from staylens.llm import jaccard_join as op
from tests_llm_helpers import EDGES, frame, words


def corpus():
    random.seed(1)
    vocabulary = [f"w{i}" for i in range(400)]
    text = [random.choice(vocabulary) for _ in range(150)]
    rows = [(i, " ".join(text)) for i in range(100, 104)]
    for i in range(40):                      # a group of near copies, each a few words off
        t = list(text)
        for _ in range(i % 5):
            t[random.randrange(150)] = "other"
        rows.append((200 + i, " ".join(t)))
    for i in range(30):
        rows.append((300 + i, " ".join(random.choice(vocabulary) for _ in range(60))))
    return rows + [r for r in EDGES if r[0] is not None]


def brute(rows):
    sets = {}
    for n, (_, t) in enumerate(rows):
        w = words(t)
        sets[n] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else ("wordless", t or "")
    classes = collections.defaultdict(list)
    for n, s in sets.items():
        classes[s].append(n)
    real = [s for s in classes if isinstance(s, frozenset)]
    links = collections.Counter()
    parent = {s: s for s in classes}

    def find(s):
        while parent[s] != s:
            s = parent[s]
        return s

    for x, a in enumerate(real):
        for b in real[x + 1:]:
            if 5 * len(a & b) >= 4 * len(a | b):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {s: min(rows[n][0] for n in v) for s, v in classes.items()}
    group = collections.defaultdict(list)
    for s in classes:
        group[find(s)].append(least[s])
    return sorted((rows[n][0], least[s], len(classes[s]), links[s], min(group[find(s)])) for n, s in sets.items())


@pytest.mark.parametrize("bucket,block", [(2048, 256), (8, 4)])
def test_same_as_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(op, "BUCKET", bucket)
    monkeypatch.setattr(op, "BLOCK", block)
    rows = corpus()
    got = sorted(tuple(r) for r in op.documents(frame(spark, rows)).collect())
    assert got == brute(rows)


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    docs = frame(spark, [(i, t, "x") for i, t in rows], "doc_id long, text string, sketch string")
    kept = op.clean(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[4] for r in brute(rows)})
    assert op.clean(docs.limit(0)).count() == 0
    assert op.clean(frame(spark, [(None, "a b c"), (None, "a b c"), (None, "d e f")])).count() == 2


def test_pruning_is_a_posterior():
    assert op.posterior(63, 63) > 0.999 and op.posterior(20, 63) < 1e-9
    assert all(0 < need <= of for of, need in op.CHECKS)
