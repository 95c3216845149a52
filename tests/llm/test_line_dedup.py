from collections import defaultdict

from pyspark.sql import functions as F

from staylens.llm import line_dedup as op
from tests_llm_helpers import EDGES, UPPER, frame

SPACE = " \t\n\x0b\x0c\r"
A, B = "A line that is long enough to count", "short one"
DOCS = EDGES + [
    (20, f"{A}\n{B}\nfirst"), (21, f"x\n  {A.upper()}\t\n{B}"), (22, f"{A}\n{A}\nlast holder\n{B}\n"),
    (23, "É" + A), (24, "é" + A), (25, "é" + A),                    # É is not lower-cased
    (26, "19 letters are few."), (27, "19 letters are few."), (28, "19 letters are few."), (31, A[:3]),
    (40, "\r\n".join(["in three documents, twice"] * 2)), (41, "in three documents, twice"), (42, "in three documents, twice"),
    (50, "seen under one id only, not shared"), (50, "seen under one id only, not shared"),
    (50, "seen under one id only, not shared\nother text of the same id"),
    (None, "held by null and two others"), (60, "held by null and two others"), (61, "held by null and two others\n"),
    (70, "\n\n\n"), (71, "a" * 200_000), (72, "\n".join(["one of very many lines"] * 5000)),
    (73, "one of very many lines"), (74, "one of very many lines\nend")]


def brute(rows, min_docs=3, min_chars=20):
    key = lambda line: line.strip(SPACE).translate(UPPER)
    holders = defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(-1 << 60 if d is None else d)
    out = []
    for d, text in rows:
        d0 = -1 << 60 if d is None else d
        lines = (text or "").split("\n")
        kept = [x for x in lines
                if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or d0 == max(holders[key(x)])]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def made(df):
    return sorted(((r.doc_id, r.dedup.n_lines, r.dedup.n_dropped, r.dedup.kept) for r in df.collect()), key=repr)


def test_same_as_brute_force(spark):
    got = made(op.deduplicate(frame(spark, DOCS), keep=["doc_id"]))
    assert got == brute(DOCS)
    assert sum(r[2] for r in got) > 5000


def test_a_line_of_every_document(spark):
    rows = [(i, f"the line that all of them have\n{i}\nlines of every third: {i % 3}") for i in range(3000)]
    assert made(op.deduplicate(frame(spark, rows), keep=["doc_id"])) == brute(rows)


def test_other_parameters(spark):
    rows = [(1, "ab\nx"), (2, "ab\ny"), (3, "z")]
    got = made(op.deduplicate(frame(spark, rows), keep=["doc_id"], min_docs=2, min_chars=2))
    assert got == brute(rows, 2, 2) and got[0] == (1, 2, 1, "x")


def test_clashing_columns_and_empty_table(spark):
    docs = frame(spark, DOCS).select("doc_id", "text", F.lit(1).alias("d"), F.lit(2).alias("v"), F.lit(3).alias("dedup"),
                                     F.lit(4).alias("h1"), F.lit(5).alias("a.b"))
    got = op.deduplicate(docs, name="cut")
    assert got.columns == ["doc_id", "text", "d", "v", "dedup", "h1", "a.b", "cut"]
    assert {(r["d"], r["v"], r["dedup"], r["a.b"]) for r in got.collect()} == {(1, 2, 3, 5)}
    empty = op.deduplicate(frame(spark, []))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "dedup"]
