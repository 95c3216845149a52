import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from staylens.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    got = queries.QUERIES[name](spark, SMALL)
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    want = con.sql(queries.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda data: sorted(repr(r) for r in data)
    assert rows(tuple(r) for r in got.select(*want.columns).collect()) == rows(want.fetchall())


def test_stages_keep_columns_and_act_on_what_is_left(spark, workdir):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{workdir}/{number}"
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        assert docs.count() <= before
        before = docs.count()
    assert 0 < before and docs.where("not exact").isEmpty()
    again = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_equal_brute_force_on_the_whole_fixture(spark, workdir):
    """Near copies and contaminated documents that go are those that all pairs and all windows name."""
    from test_jaccard_join import brute as near
    from tests_llm_helpers import words

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id for r in stages["n-gram Jaccard join"](spark, docs, SMALL).collect()}
    assert kept == {r[4] for r in near(rows)} and len(kept) < len(rows)
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes = {len(x) for x in windows}

    def contaminated(text):
        w = words(text)
        hit = {k for n in sizes for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in windows for k in range(i, i + n)}
        return bool(hit) and 20 * len(hit) >= len(w)

    kept = {r.doc_id for r in stages["benchmark decontamination"](spark, docs, SMALL).collect()}
    assert kept == {i for i, t in rows if not contaminated(t)} and len(kept) < len(rows)


def test_empty_tables_and_one_very_long_word(spark, workdir):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{workdir}/{name}.parquet")
    assert corpus_pipeline.run(spark, workdir).count() == 0
    docs = spark.createDataFrame([(1, "x" * 1_000_000, "en", "s", 1_000_000), (2, None, None, None, None)],
                                 spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    docs.write.mode("overwrite").parquet(f"{workdir}/documents.parquet")
    assert corpus_pipeline.run(spark, workdir).count() == 2
