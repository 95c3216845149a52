"""File queries: bookings written by one end of a job and read back by the other."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.names import clean_columns
from ..operators import profile as P
from ..operators.columns import RawContract, processed_input
from ..operators.preprocess import FeatureVector
from ..session import scratch_path
from ..sources.files import RAW_TYPES, read_processed, read_raw_csv, write_processed, write_table
from ..sources.tables import bookings
from .catalog import r6, register
from .frames import profile_frame
from .oracle import EDA_CTE, PREPARED_CTE, union_all, with_ctes
from .q_fit import prepared_features

ID, LABEL = "booking_id", "is_canceled"
RAW = ("hotel", LABEL, "lead_time", "children", "country", "market_segment", "agent", "company", "assigned_room_type", "adr")
_RAW_SQL = f"SELECT booking_id, {', '.join(c for c in RAW if c != 'adr')}, round(adr, 6) AS adr FROM bookings"


def _raw_rows(df):
    return df.select(ID, *[c for c in RAW if c != "adr"], r6("adr").alias("adr"))


@register("raw_csv_scan", with_ctes(_RAW_SQL))
def raw_csv_scan(spark, sf_dir):
    """Bookings as a raw CSV file has them (titled names, NA for what is missing), read back typed."""
    path = scratch_path(spark, "raw-csv")
    text = bookings(spark, sf_dir).select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c.replace("_", " ").title())
                                            for c in (ID, *RAW)])
    text.write.option("header", True).csv(path)
    return _raw_rows(clean_columns(read_raw_csv(spark, path, RAW_TYPES | {ID: "bigint"})))


@register("raw_record_batch", with_ctes(_RAW_SQL))
def raw_record_batch(spark, sf_dir):
    """Bookings as JSON records with numbers as text, through the raw contract."""
    path = scratch_path(spark, "records")
    rows = bookings(spark, sf_dir).select(ID, *RAW)
    rows.select(ID, *[F.col(c).cast("string").alias(c) if c in ("lead_time", "adr", "children") else F.col(c) for c in RAW]).write.json(path)
    types = {c: RAW_TYPES[c] for c in RAW}
    # A column that is null in all records is in none of them.
    records = spark.read.json(path)
    absent = [F.lit(None).cast("string").alias(c) for c in RAW if c not in records.columns]
    return _raw_rows(RawContract(types | {ID: "bigint"}).transform(records.select("*", *absent)))


_PROCESSED = ("lead_time", "adr", "total_nights", "total_guests", "is_room_changed")


@register("processed_table", with_ctes(
    f"SELECT booking_id, {', '.join(f'round(CAST({c} AS DOUBLE), 6) AS {c}' for c in _PROCESSED)}, is_canceled FROM prepared",
    PREPARED_CTE))
def processed_table(spark, sf_dir):
    """Processed rows written with the label last, as CSV, and read as features and label."""
    path = scratch_path(spark, "processed")
    write_processed(prepared_features(spark, sf_dir).select(LABEL, ID, *_PROCESSED), path, LABEL, "csv")
    rows, features = read_processed(spark, path, LABEL, "csv")
    if features != [ID, *_PROCESSED] or rows.columns[-1] != LABEL:
        raise ValueError("the label is not the last column")
    return rows.select(ID, *[r6(F.col(c).cast("double")).alias(c) for c in _PROCESSED], LABEL)


@register("result_table", with_ctes("""
SELECT market_segment, round(avg(try_cast(is_canceled AS DOUBLE)), 6) AS cancel_rate
FROM eda WHERE market_segment IS NOT NULL GROUP BY market_segment""", EDA_CTE))
def result_table(spark, sf_dir):
    """A result written as a table with a header."""
    path = scratch_path(spark, "result")
    write_table(P.group_rate(profile_frame(spark, sf_dir), "market_segment", LABEL, "cancel_rate"), path)
    rows = spark.read.option("header", True).csv(path)
    return rows.select("market_segment", F.round(F.col("cancel_rate").cast("double"), 6).alias("cancel_rate"))


_FEATURES = ("total_guests", "adr", "is_domestic", "total_nights", "is_room_changed", "previous_cancellations", "has_children")


@register("feature_selection", with_ctes(union_all([
    f"SELECT booking_id, '{c}' AS feature, round(CAST({c} AS DOUBLE), 6) AS value FROM prepared" for c in _FEATURES]), PREPARED_CTE))
def feature_selection(spark, sf_dir):
    """Processed records checked, reordered to the model's features and taken as its vector."""
    names = list(_FEATURES)
    numeric = prepared_features(spark, sf_dir).select(ID, *sorted(names), "lead_time")
    vectors = FeatureVector(names, "features").transform(processed_input(numeric, names, keep=[ID]))
    entries = vectors.select(ID, F.posexplode(vector_to_array("features")).alias("i", "value"))
    return entries.select(ID, F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1).alias("feature"), r6("value").alias("value"))
