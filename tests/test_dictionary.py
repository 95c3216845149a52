"""The category dictionary as a table: many categories, large parts, saving, sparse vectors."""

import os

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from staylens.operators import encode
from staylens.operators.preprocess import BookingPreprocessor, BookingPreprocessorModel
from staylens.sources.files import save_model


def coded(spark, n, codes):
    return spark.range(n).select("id", (F.col("id") % 3).cast("int").alias("is_canceled"), (F.col("id") % 50).cast("double").alias("x"),
                                 F.format_string("c%07d", F.col("id") * 7919 % codes).alias("code"),
                                 F.when(F.col("id") % 5 > 0, F.col("id") % 4).cast("string").alias("group"))


def prep(**kw):
    return BookingPreprocessor(labelCol="is_canceled", passthroughCols=["id"], **kw)


def expected(row, model):
    """A row's vector from the dictionary, in plain Python."""
    st = model.fitted
    names = {r["feature"]: r["index"] for r in model.feature_table().collect()}
    out = {names["x"]: (row["x"] - 0.0) / 49.0}
    for c in st["categorical"]:
        at = names.get(f"{c}_{row[c] if row[c] is not None else st['fill'][c]}")
        if at is not None:
            out[at] = 1.0
    return {k: v for k, v in out.items() if v}


def test_five_thousand_categories_become_a_sparse_vector(spark):
    train = coded(spark, 12_000, 5000)
    model = prep().fit(train)
    assert not model.wide and model.fitted["n_features"] == 1 + 5000 + 4
    table = model.dictionary_table
    for c, k in (("code", 5000), ("group", 4)):
        own = table.where(F.col("column") == c).orderBy("slot").collect()
        assert [r["slot"] for r in own] == list(range(k))
        assert [r["category"] for r in own] == sorted(r["category"] for r in own)
    assert table.where("column = 'code'").agg(F.sum("n")).first()[0] == 12_000
    rows = coded(spark, 40, 5000).withColumn("code", F.when(F.col("id") == 7, "unseen").otherwise(F.col("code")))
    vectors = {r["id"]: r["features"] for r in model.transform(rows).collect()}
    entries = {}
    for r in model.entries(rows).collect():
        entries.setdefault(r["id"], {})[r["index"]] = r["value"]
    for row in rows.collect():
        want, got = expected(row, model), vectors[row["id"]]
        assert isinstance(got, SparseVector) and got.size == 5005
        assert dict(zip(got.indices.tolist(), got.values.tolist())) == pytest.approx(want)
        assert entries.get(row["id"], {}) == pytest.approx(want)
    with pytest.raises(ValueError, match="feature_table"):
        model.feature_columns


def test_a_million_categories(spark):
    train = coded(spark, 1_000_000, 1_000_000)
    model = prep().fit(train)
    assert model.fitted["sizes"]["code"] == 1_000_000
    some = coded(spark, 1_000_000, 1_000_000).where("id % 100003 = 0")
    for row, made in zip(some.orderBy("id").collect(), model.transform(some).orderBy("id").collect()):
        # Codes have seven digits and are all there, so the slot is the number itself.
        assert int(row["code"][1:]) + 1 in made["features"].indices.tolist()
        assert made["features"].size == 1_000_005


def test_a_large_part_is_joined_with_its_frequent_categories_apart(spark, monkeypatch):
    train = coded(spark, 6000, 300).withColumn("code", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("code")))
    model = prep(wideFeatures=10).fit(train)
    small = model.transform(train).orderBy("id").collect()
    monkeypatch.setattr(encode, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(encode, "FREQUENT", 0.1)
    assert model.transform(train).orderBy("id").collect() == small


def test_wide_and_vector_results_agree(spark):
    train = coded(spark, 2000, 40).withColumn("always", F.lit("one"))
    test = coded(spark, 60, 40).withColumn("always", F.when(F.col("id") % 2 == 0, "one").otherwise("other"))
    for scale in ("minmax", "standard"):
        wide = prep(scaleMethod=scale).fit(train)
        tall = prep(scaleMethod=scale, wideFeatures=3).fit(train)
        assert wide.wide and not tall.wide
        names = wide.feature_columns
        assert {r["index"]: r["feature"] for r in tall.feature_table().collect()} == dict(enumerate(names))
        a = [[r[c] for c in names] for r in wide.transform(test).orderBy("id").collect()]
        b = [r["features"].toArray().tolist() for r in tall.transform(test).orderBy("id").collect()]
        assert np.allclose(a, b, rtol=0, atol=1e-12)


def test_dictionary_is_saved_with_the_model(spark, workdir):
    train = coded(spark, 3000, 2000)
    model = prep(wideFeatures=100).fit(train)
    path = os.path.join(workdir, "prep")
    save_model(model, path)
    again = BookingPreprocessorModel.load(path)
    assert again.dictionary_table.inputFiles()[0].startswith("file:" + path) or path in again.dictionary_table.inputFiles()[0]
    assert again.dictionary_table.exceptAll(model.dictionary_table).isEmpty()
    assert again.transform(train).orderBy("id").collect() == model.transform(train).orderBy("id").collect()


def test_no_rows_and_null_columns(spark):
    empty = coded(spark, 10, 5).where("id < 0")
    assert prep().fit(empty).transform(empty).count() == 0
    nulls = coded(spark, 10, 5).withColumn("code", F.lit(None).cast("string"))
    model = prep().fit(nulls)
    assert "code_Unknown" in model.feature_columns
