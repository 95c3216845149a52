import math

from staylens.llm import license_scan as op
from tests_llm_helpers import EDGES, frame, words

DOCS = EDGES + [
    (20, "Licensed under CC BY 4.0. CC-BY cc by cc by"), (21, "All rights\nreserved, all rights reserved"),
    (22, "filler " * 100 + "Licensed under the Apache License, Version 2.0." + " tail" * 50),
    (23, "This work is licensed under the GNU General Public License, version 3."), (24, "reserved rights all"),
    (25, "license version apache the under licensed"), (26, "cc bye accby cc  by"), (27, "Released under the MIT License")]


def brute(text, templates=op.TEMPLATES):
    w = words(text)
    places = [(i, label, p) for p, label in op.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    labels, best = {x[1] for x in places}, 0.0
    for label, t in templates:
        own, block = set(t.split()), op.STRETCH * len(t.split())
        for s in range(len(w)):
            if w[s] in own:
                held = len(own.intersection(w[s:s + block]))
                if held >= math.ceil(round(op.CONTAINED * len(own), 9)):
                    labels.add(label)
                    best = max(best, held / len(own))
    at = [p[0] for p in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x[1] for x in places})),
            ",".join(sorted(labels)), 1.0 if at else best)


def test_same_as_brute_force(spark):
    rows = op.scan(frame(spark, DOCS)).collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        assert tuple(r.license[c] for c in op.COLUMNS) == brute(r.text), r.text[:60]


def test_other_templates_and_empty_tables(spark):
    docs = frame(spark, [(1, "alpha beta gamma", 3)], "doc_id long, text string, license int")
    made = op.scan(docs, keep=["license"], name="found", templates=[("x", "beta alpha"), ("none", "")]).first()
    assert made.license == 3 and made.found.labels == "x" and made.found.score == 1
    assert op.scan(docs, keep=["doc_id"], templates=[]).first().license.labels == ""
    assert op.scan(frame(spark, [])).count() == 0


LONG = " ".join(f"word{i}" for i in range(50)) + " " + " ".join(f"word{i}" for i in range(10))
SHORT = " ".join(f"term{i}" for i in range(20))


def test_long_templates_are_found_at_every_offset(spark):
    """A 60-word template, and a 20-word one with inserted words, wherever they stand; a part of one is not found."""
    broken = SHORT.split()
    for k in range(8):
        broken.insert(2 * k + 3, f"inserted{k}")
    docs = [(i, "fill " * i + LONG + " tail" * 40) for i in range(100)]
    docs += [(100 + i, "fill " * i + " ".join(broken) + " tail" * (40 - i)) for i in range(40)]
    docs += [(200, " ".join(LONG.split()[:40])), (201, " ".join(x for t in SHORT.split() for x in (t, "far", "apart")))]
    made = op.scan(frame(spark, docs), templates=[("long", LONG), ("short", SHORT)])
    for r in made.collect():
        want = "long" if r.doc_id < 100 else "short" if r.doc_id < 200 else ""
        assert r.license.labels == want, r.doc_id
        assert r.license.labels == brute(r.text, [("long", LONG), ("short", SHORT)])[5]


def test_thousands_of_templates(spark):
    many = [(f"t{i}", " ".join(f"w{(i * 31 + k * 7) % 4001}" for k in range(12))) for i in range(2000)]
    docs = [(i, "before the text " + many[i * 37][1] + " and after it") for i in range(50)] + [(60, "w1 w2 w3 nothing")]
    for r in op.scan(frame(spark, docs), templates=many).collect():
        assert r.license.labels == brute(r.text, many)[5], r.doc_id
