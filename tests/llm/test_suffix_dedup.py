import numpy as np
import pyarrow as pa
import pytest

from staylens.llm import suffix_dedup as op
from tests_llm_helpers import frame, sha

rng = np.random.default_rng(0)
BASE = "".join(rng.choice(list("abc "), 2500))
DOCS = list(enumerate([
    "", None, "a" * 49, "a" * 50, "a" * 51, BASE, BASE[100:400], BASE[10:70] + "Q" + BASE[200:249] + "Z" + BASE[300:350],
    "x" * 400, "x" * 60 + "y" + "x" * 55, "abcab" * 100, ("abcab" * 100)[3:120] + "é" * 60, "é" * 70, BASE[::-1], BASE,
    "begin " + BASE[500:900] + " end", "\x00" * 120, "\x00" * 60 + BASE[40:95]]))


def brute(rows):
    out, seen = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if seen.setdefault(b[p:p + 50], i) < i:
                gone[p:p + 50] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i] = len(b), int(gone.sum()), runs, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


@pytest.mark.parametrize("hot,shard", [(op.HOT, op.SHARD), (2, 3)])
def test_same_as_brute_force(spark, monkeypatch, hot, shard):
    monkeypatch.setattr(op, "HOT", hot)
    monkeypatch.setattr(op, "SHARD", shard)
    got = {r.doc_id: (r.dedup.n_bytes, r.dedup.n_removed, r.dedup.n_spans, r.dedup.kept_sha256)
           for r in op.deduplicate(frame(spark, DOCS), keep=["doc_id"]).collect()}
    assert got == brute(DOCS)


def test_equal_ids_do_not_repeat_each_other(spark):
    text = BASE[:200]
    rows = [(5, text), (5, text), (5, "other " + text), (None, text), (9, "q" + text[:60])]
    got = {(r.doc_id, r.text): r.dedup.n_removed for r in op.deduplicate(frame(spark, rows)).collect()}
    assert got == {(5, text): 0, (5, "other " + text): 0, (None, text): 200, (9, "q" + text[:60]): 60}
    assert op.deduplicate(frame(spark, [])).count() == 0


def test_stretches_do_not_matter(monkeypatch):
    raw = np.frombuffer((BASE + "x" * 90).encode(), np.uint8)
    rows = np.array([0, 700, 700, 740, len(raw)])
    want = [x.tolist() for x in op.triggers(raw, rows)]
    monkeypatch.setattr(op, "STRETCH", 64)
    assert [x.tolist() for x in op.triggers(raw, rows)] == want


def test_strings_of_a_row_are_told_by_its_end_not_by_each_byte(monkeypatch):
    texts = [BASE[:n] for n in (0, 49, 50, 700, 3, 0, 51)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    rows = np.cumsum([0, *map(len, texts)])
    h = op._rolled(np.ndarray(len(raw), "<u8", strides=(1,), buffer=np.concatenate([raw, np.zeros(90, np.uint8)])), len(raw) - 20)
    ends = rows[np.searchsorted(rows, np.arange(len(raw)), side="right")]
    want = sorted({a + int(np.argmin(h[a:a + op.FREE + 1])) for a in range(len(raw)) if a + op.LENGTH <= ends[a]})
    search, looked = np.searchsorted, []
    monkeypatch.setattr(np, "searchsorted", lambda a, v, **how: looked.append(np.size(v)) or search(a, v, **how))
    assert op.triggers(raw, rows)[0].tolist() == want
    assert max(looked) <= len(rows)


def test_tasks_hold_no_table_of_all_triggers(spark, monkeypatch):
    """A filter of fixed size let nearly everything pass on large inputs, and what it let pass filled the disk."""
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *a: 1 / 0)
    got = {r.doc_id: r.dedup.n_removed for r in op.deduplicate(frame(spark, DOCS), keep=["doc_id"]).collect()}
    assert got == {i: v[1] for i, v in brute(DOCS).items()}


def test_a_trigger_travels_once_in_few_bytes(monkeypatch):
    texts = ["".join(rng.choice(list("abcdefgh "), 30_000)) for _ in range(20)]
    ids = pa.array(range(5_000_000, 5_000_020), pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(texts), ids, ids], names=["text", "ord", "th"])
    n, rows = len(op.Occurrences(batch).h), [r for b in op._parsed(iter([batch])) for r in b.to_pylist()]
    packed = [len(r["data"]) for r in rows if r["kind"] == op.TRIGGERS]
    assert n > 30_000 and n <= sum(packed) / 19 and sum(packed) <= 21 * n
    # Buckets are even although the hashes, being least ones, are not.
    assert len(packed) > 0.99 * (1 << op.BUCKET) and max(packed) < 5 * sum(packed) / len(packed)


@pytest.mark.parametrize("hot,shard,bits", [(op.HOT, op.SHARD, op.BUCKET), (2, 40, 2)])
def test_many_shards_with_rows_that_come_twice(spark, monkeypatch, hot, shard, bits):
    monkeypatch.setattr(op, "HOT", hot)
    monkeypatch.setattr(op, "SHARD", shard)
    monkeypatch.setattr(op, "BUCKET", bits)
    pick = np.random.default_rng(1)
    parts = [BASE[a:a + n] for a, n in zip(pick.integers(0, 2400, 60).tolist(), pick.integers(20, 130, 60).tolist(), strict=True)]
    rows = [(int(i), "".join(pick.choice(parts + ["é~", "#" * 90], 6))) for i in pick.permutation(160) - 20]
    got = op.deduplicate(frame(spark, rows + rows[:80]).repartition(7), keep=["doc_id"]).collect()
    want = brute(rows)
    assert len(got) == 240 and {r.doc_id for r in got} == set(want)
    assert all((r.dedup.n_bytes, r.dedup.n_removed, r.dedup.n_spans, r.dedup.kept_sha256) == want[r.doc_id] for r in got)
