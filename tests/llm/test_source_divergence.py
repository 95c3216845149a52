import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from staylens.llm import source_divergence as op
from tests_llm_helpers import EDGES, UPPER, frame

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        found, total, own = Counter(), Counter(), defaultdict(Counter)
        for x, source, words in docs:
            if x == lang:
                found.update(set(words))
                total.update(words)
                own[source].update(words)
        kept = [t for t in found if found[t] >= min_docs]

        def shares(count):
            whole = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (count[t] + 5) // whole for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(total)
        for s in p:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in p if o != s)
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if own[s][t] and p[s][t] > q[t])[:top]
            for part, ranked in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -v, r) for r, (v, item) in enumerate(ranked, 1)]
    return sorted(out)


def made(df):
    return sorted(tuple(r) for r in df.collect())


TEXTS = [t for _, t in EDGES] + ["Alpha beta BETA, gamma", "alpha\tbeta2beta delta-Alpha", "Éa éa ÉA", "ünder\x7funder", ""]
ROWS = [(lang, f"s{(i * 7 + j) % k}" if (i + j) % 11 else None, text)
        for j, (lang, k) in enumerate([("en", 5), ("de", 3), (None, 2)]) for i, text in enumerate(TEXTS * 3)]
ROWS += [("xx", "only", "lonely words"), ("yy", "a", "rare"), ("yy", "b", None), ("yy", "é", "")]
COLUMNS = "lang string, source string, text string"


@pytest.mark.parametrize("min_docs, terms, sources", [(3, 2048, 128), (2, 2, 2), (1, 3, 1)])
def test_same_as_brute_force(spark, min_docs, terms, sources):
    got = made(op.audit(frame(spark, ROWS, COLUMNS), min_docs=min_docs, top=4, terms=terms, sources=sources))
    assert got == brute(ROWS, min_docs, 4)
    assert {r[2] for r in got} == {"pair", "term"}


def test_without_kept_terms_and_empty_table(spark):
    rows = [("en", "a", "x"), ("en", "b", "y"), ("en", "c", None)]
    got = made(op.audit(frame(spark, rows, COLUMNS)))
    assert got == brute(rows, op.MIN_DOCS, op.TOP) and len(got) == 6 and {r[4] for r in got} == {0}
    assert op.audit(frame(spark, [], COLUMNS)).count() == 0


def test_large_counts_are_exact(spark):
    count, kept, terms = 999_999_999_999, 7_777_777_777_777, 123_457
    row = spark.range(1).select(op.share(F.lit(count), F.lit(kept), F.lit(terms)).alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (count + 5) // (kept + 5 * terms)
    import numpy as np
    assert op.shares(np.array([count]), np.array([kept + 5 * terms]))[0] == row.p


def test_counts_handed_on_early_are_the_same(spark, monkeypatch):
    monkeypatch.setattr(op, "HELD", 2)
    assert made(op.audit(frame(spark, ROWS, COLUMNS), min_docs=3, top=4)) == brute(ROWS, 3, 4)


def test_clashing_columns(spark):
    docs = frame(spark, ROWS, "term string, kept string, cells string").withColumn("base", F.lit(1))
    assert made(op.audit(docs, lang="term", source="kept", text="cells", min_docs=3, top=4)) == brute(ROWS, 3, 4)
