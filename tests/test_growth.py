"""Each input is derived once, and projections stay short enough to be compiled."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from conftest import SF_SMALL
from staylens.operators import preprocess, train
from staylens.operators.preprocess import BookingPreprocessor, FeatureVector
from staylens.plans import catalog, training

catalog.load_all()
from staylens.plans import q_fit, q_train  # noqa: E402


def scans(df, what):
    return df._jdf.queryExecution().optimizedPlan().toString().count(what)


def test_scaled_rows_come_from_one_table(spark):
    for name in ("minmax_transform", "standard_transform"):
        assert scans(catalog.QUERIES[name](spark, SF_SMALL), "l_returnflag") == 0


def test_split_reads_deduplicated_rows_from_a_table(spark, monkeypatch):
    seen, split = [], training.assign_split
    monkeypatch.setattr(training, "assign_split", lambda df, *a, **k: seen.append(df) or split(df, *a, **k))
    data = training.prepare_training_data(spark, q_train.training_raw(spark, SF_SMALL), q_train.LABEL, q_train.ID, folds=3)
    assert scans(seen[0], "Aggregate") == 0 and scans(seen[0], "l_returnflag") == 0
    assert not data.train.storageLevel.useMemory and not data.test.storageLevel.useMemory


def test_search_holds_its_rows_and_lets_them_go(spark, monkeypatch):
    rows = spark.range(40).select((F.col("id") % 2).cast("double").alias("label"), F.col("id").cast("double").alias("x"),
                                  (F.col("id") % 3).cast("int").alias("fold"))
    rows = FeatureVector(["x"], "features").transform(rows)
    held, fit = [], train._searched
    monkeypatch.setattr(train, "_searched", lambda n, t, c: held.append(t.storageLevel.useMemory) or fit(n, t, c))
    cfg = train.SearchConfig(n_iter=1, folds=3, grids={"random_forest": {"numTrees": [2], "maxDepth": [2]}})
    train.search("random_forest", rows, cfg)
    assert held == [True] and not rows.storageLevel.useMemory


def test_fit_writes_its_rows_once_and_caches_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, "a", 0), (None, "b", 1), (float("nan"), None, 1)], "x double, k string, is_canceled int")
    names, stored = [], preprocess.stored
    monkeypatch.setattr(preprocess, "stored", lambda d, name: names.append(d.columns) or stored(d, name))
    monkeypatch.setattr(type(df), "persist", lambda *a, **k: 1 / 0)
    model = BookingPreprocessor().fit(df)
    assert names == [["x", "k"]] and model.fitted["rows"] == 3 and model.feature_columns == ["x", "k_a", "k_b"]


def test_vectors_equal_the_named_columns_without_an_expression_for_each(spark):
    df = spark.createDataFrame([(1.0, "a", "p", 0), (3.0, "b", None, 1), (None, None, "q", 1), (9.0, "c", "q", 0)],
                               "x double, k string, l string, is_canceled int")
    for method in ("minmax", "standard"):
        model = BookingPreprocessor(scaleMethod=method, outputCol="features").fit(df)
        new = df.union(spark.createDataFrame([(2.0, "unseen", "p", 0)], df.schema))
        out = model.transform(new)
        for r in out.collect():
            assert r["features"].toArray().tolist() == [r[c] for c in model.feature_columns]
        assert scans(out.select("features"), "CASE WHEN (_slot") == 2      # one for each text column
    texts = model.copy({model.outputCol: "features"}).transform(df).select("features").schema["features"].metadata
    assert texts["ml_attr"]["num_attrs"] == len(model.feature_columns)


def test_rounding_of_doubles_equals_round(spark):
    values = [0.0, -0.0, 1.0, -1.0, 0.5e-6, -0.5e-6, 1.5e-6, 2.5e-6, 1.0000005, 0.1234565, -0.1234565, 0.12345649999999999, 1e-9, -1e-9,
              1e5 + 0.5e-6, 123456.7890125, 99999.9999995, 1e5, 1e11, 1.7e308, 1 / 3, 2 / 3, math.pi * 1e7, float("inf"), float("-inf"),
              float("nan"), None] + [k / 977 - 3 for k in range(6000)] + [(2 * k + 1) * 0.5e-6 for k in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    found = rows.select("v", catalog.r6(F.col("v")).alias("want"), catalog.r6_double(F.col("v")).alias("got"))
    text = lambda c: F.col(c).cast("string")
    assert found.where(~text("want").eqNullSafe(text("got"))).collect() == []
    assert found.count() == len(values)
    assert "r6_double" in q_fit._long.__code__.co_names


def split_of_many_rows(spark, monkeypatch):
    """A train split of 30,000 rows for the queries that fit a forest; one tree of one split without bootstrap."""
    rows = spark.range(30_000).select(F.col("id").alias("booking_id"), (F.col("id") % 2).cast("double").alias("label"),
                                      F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    rows = FeatureVector(["x", "y"], "features").transform(rows)
    data = training.TrainingData(rows, rows, None, ["x", "y"], q_train.ID, q_train.LABEL, "")
    monkeypatch.setattr(q_train, "prepare_training_data", lambda *a, **k: data)
    monkeypatch.setattr(q_train, "POINT", {"numTrees": 1, "maxDepth": 1, "bootstrap": False})


def rows_of_root(model):
    return sum(model.trees[0]._call_java("rootNode").impurityStats().stats())


def test_importances_are_of_a_forest_over_every_train_row(spark, monkeypatch):
    split_of_many_rows(spark, monkeypatch)
    fits, table = [], q_train.importance_table
    monkeypatch.setattr(q_train, "importance_table", lambda s, model, names: fits.append(model) or table(s, model, names))
    assert q_train.feature_importance_top5(spark, SF_SMALL).count() == 2
    assert rows_of_root(fits[0]) == 30_000


def test_scores_are_of_a_forest_over_every_train_row(spark, monkeypatch):
    split_of_many_rows(spark, monkeypatch)
    assert rows_of_root(q_train._fitted(spark, SF_SMALL)[1]) == 30_000
