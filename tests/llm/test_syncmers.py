import random

import numpy as np

from staylens.llm import syncmers as op
from staylens.llm.textbatch import mix64
from tests_llm_helpers import frame, sha


def brute(rows):
    rows = sorted(rows, key=lambda r: r[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        e = op.edited(t, following)
        f, g, h = (op.fingerprint(*op.anchors(x.encode())) for x in (t, e, following))
        out[i] = len(t), sha(e), f, g, op.likeness(f, g), op.likeness(f, h)
    return out


def test_successors_same_as_brute_force(spark):
    rows = [(i, f"text number {i} " * (i % 9)) for i in range(0, 200, 3)] + [(500, None), (501, ""), (7, "é" * 90),
                                                                               (10_000, "a" * 5000), (8, "x")]
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
           for r in op.with_successors(frame(spark, rows)).collect()}
    assert got == brute(rows)
    assert op.with_successors(frame(spark, [(3, "only one")])).count() == 1
    assert op.with_successors(frame(spark, [])).count() == 0
    many = op.with_successors(frame(spark, [(1, "same"), (1, "same"), (None, "other"), (1, "third")])).collect()
    assert len(many) == 4 and sum(r.doc_id is None for r in many) == 1


def test_anchors_do_not_depend_on_their_surroundings():
    inner = " ".join(f"w{i * 37 % 101}" for i in range(200)).encode()
    at, h = op.anchors(inner)
    moved, g = op.anchors(b"prefix of some bytes " + inner + b" and a suffix")
    there = set(zip((moved - 21).tolist(), g.tolist(), strict=True))
    assert set(zip(at.tolist(), h.tolist(), strict=True)) <= there
    a, b = op.fingerprint(at, h), op.fingerprint(moved, g)
    assert op.likeness(a, a) == 1 and op.likeness(a, b) > 0.8
    none = op.fingerprint(at[:0], h[:0])
    assert op.likeness(none, none) == 1 and op.likeness(a, none) == 0


def test_fingerprints_keep_columns(spark):
    rows = op.fingerprints(frame(spark, [(1, "x", "a" * 50)], "doc_id long, syn string, text string")).collect()
    assert rows[0].syn == "x" and len(rows[0].syncmers.positions) == len(rows[0].syncmers.hashes) > 0


def test_short_texts_without_a_syncmer_differ():
    random.seed(5)
    texts = ["".join(random.choice("abcdef ") for _ in range(n)) for n in range(1, 40) for _ in range(20)]
    texts = sorted({*texts, "Eser thed nt of."})
    found = [op.anchors(t.encode())[1] for t in texts]
    assert all(len(h) for h in found)
    empty = op.fingerprint(*op.anchors(b""))
    assert all(op.likeness(op.fingerprint(*op.anchors(t.encode())), empty) == 0 for t in texts)
    short = [h for t, h in zip(texts, found, strict=True) if len(t) >= 12 and len(h) == 1]
    assert len({int(h[0]) for h in short}) == len(short) > 20


def test_anchors_by_definition():
    """A stretch is an anchor if the least hash of its inner stretches is that of the first or of the last one."""
    random.seed(8)
    for n in (15, 16, 17, 40, 300):
        text = "".join(random.choice("abc de\n") for _ in range(n)).encode()
        inner = [int(mix64(np.array([int.from_bytes(text[i:i + op.S], "little")], np.uint64))[0]) for i in range(n - op.S + 1)]
        want = [i for i in range(n - op.K + 1)
                if min(inner[i:i + op.K - op.S + 1]) in (inner[i], inner[i + op.K - op.S])]
        at, h = op.anchors(text)
        assert at.tolist() == (want or [0]) and len(h) == len(at)


def test_other_order_is_less_alike():
    random.seed(9)
    parts = [" ".join(f"w{random.randrange(5000)}" for _ in range(60)) for _ in range(20)]
    text, turned = "\n".join(parts), "\n".join(reversed(parts))
    near = "\n".join([*parts[:7], "one inserted line", *parts[7:]])
    f, g, h = (op.fingerprint(*op.anchors(t.encode())) for t in (text, turned, near))
    assert op.likeness(f, f) == 1 and op.likeness(f, h) > 0.9 and op.likeness(f, g) < 0.3
    assert op.likeness(f, g) == op.likeness(g, f) or abs(op.likeness(f, g) - op.likeness(g, f)) < 1e-9
    values = [3, 1, 2, 5, 4, 9]
    assert op._chain(np.array(values)) == 4 and op._chain(np.array([])) == 0
