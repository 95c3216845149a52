"""Edge cases where pandas and Spark defaults differ (FIXTURES.md extra edges)."""

import math

import pytest
from pyspark.sql import functions as F

from staylens.functions.features import hotel_features, nan_to_null
from staylens.operators import profile as P
from staylens.operators.impute import fit_imputer
from staylens.operators.preprocess import BookingPreprocessor
from staylens.operators.ranks import exact_quantiles


def test_even_count_median_and_p99(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.5, 0.99]).collect()}
    assert got[0.5] == 2.5
    assert math.isclose(got[0.99], 9.79, rel_tol=1e-12)


def test_constant_column_min_max_is_zero(spark):
    df = spark.createDataFrame([(5, "a"), (5, "b")], "k int, c string")
    out = BookingPreprocessor(labelCol="").fit(df).transform(df)
    assert [r["k"] for r in out.collect()] == [0.0, 0.0]


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "c string")
    assert fit_imputer(df) == {"c": "a"}
    assert P.modes(df, ["c"]).first()["mode"] == "a"


def test_room_change_null_rules(spark):
    df = spark.createDataFrame([("A", "A"), (None, None), (None, "B"), ("A", "C")],
                               "reserved_room_type string, assigned_room_type string")
    got = [r["is_room_changed"] for r in hotel_features(df).collect()]
    assert got == [0, 1, 1, 1]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (4.0,)], "x double")
    assert nan_to_null(df).where(F.col("x").isNull()).count() == 2
    assert fit_imputer(df) == {"x": 4.0}


def test_unseen_category_and_missing_column(spark):
    train = spark.createDataFrame([("x", 1), ("y", 2)], "c string, n int")
    model = BookingPreprocessor(labelCol="").fit(train)
    test = spark.createDataFrame([(3,)], "n int")  # categorical column absent -> 'Unknown'
    row = model.transform(test).first().asDict()
    assert row["c_x"] == 0.0 and row["c_y"] == 0.0
    assert row["n"] == 2.0  # (3 - 1) / (2 - 1): no clipping


def test_all_null_columns(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x double, s string")
    assert fit_imputer(df) == {"x": 0.0, "s": "Unknown"}
    desc = P.categorical_describe(df, ["s"]).first()
    assert desc["count"] == 0 and desc["unique"] == 0 and desc["top"] is None


def test_name_collision_is_an_error(spark):
    from staylens.functions.names import clean_columns
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError):
        clean_columns(df)


def test_category_text_with_dots_and_backticks(spark):
    df = spark.createDataFrame([("9.0", 1.0, 0), ("12.0", 2.0, 1), ("a`b", 3.0, 0)],
                               "agent_code string, x double, is_canceled int")
    model = BookingPreprocessor(labelCol="is_canceled", outputCol="features").fit(df)
    assert "agent_code_9.0" in model.feature_columns and "agent_code_a`b" in model.feature_columns
    rows = model.transform(df).orderBy("x").collect()
    assert [r["features"].toArray().tolist() for r in rows][0] == [0.0, 0.0, 1.0, 0.0]
