"""The reference's three unit tests, re-created on the Spark API (FIXTURES.md section 1)."""

from pyspark.sql import functions as F

from staylens.functions.names import clean_columns
from staylens.operators.impute import apply_imputer, fit_imputer
from staylens.operators.preprocess import BookingPreprocessor


def test_clean_column_names_and_missing_fill(spark):
    df = spark.createDataFrame([("A", 10.0), (None, None), ("A", 30.0)],
                               "`Customer Type` string, Age double")
    cleaned = clean_columns(df)
    assert "customer_type" in cleaned.columns and "age" in cleaned.columns
    values = fit_imputer(cleaned, "median", "mode")
    assert values == {"age": 20.0, "customer_type": "A"}
    filled = apply_imputer(cleaned, values)
    assert filled.where(F.col("age").isNull() | F.col("customer_type").isNull()).count() == 0


def test_transform_reuses_train_schema_for_unseen_categories(spark):
    train = spark.createDataFrame([("City Hotel", 10, "BB"), ("Resort Hotel", 20, "HB")],
                                  "hotel string, lead_time int, meal string")
    test = spark.createDataFrame([("New Hotel", 15, "SC")], "hotel string, lead_time int, meal string")
    model = BookingPreprocessor(labelCol="is_canceled").fit(train)
    tr = model.transform(train)
    te = model.transform(test)
    assert te.columns == tr.columns
    assert "hotel_City Hotel" in tr.columns
    assert "hotel_New Hotel" not in te.columns
    row = te.first().asDict()
    assert all(row[c] == 0.0 for c in te.columns if c.startswith(("hotel_", "meal_")))


def test_room_change_feature_is_created_before_dropping_assigned_room_type(spark):
    train = spark.createDataFrame([("A", "A", 10), ("A", "D", 20)],
                                  "reserved_room_type string, assigned_room_type string, lead_time int")
    out = BookingPreprocessor(labelCol="is_canceled").fit(train).transform(train)
    assert "is_room_changed" in out.columns
    assert "assigned_room_type_A" not in out.columns
    assert [r["is_room_changed"] for r in out.orderBy("lead_time").collect()] == [0.0, 1.0]
