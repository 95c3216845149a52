"""Row-level queries: names, drop, target split, model features, alignment, dedupe, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.features import hotel_features
from ..functions.labels import label_text, risk_level
from ..functions.names import clean_columns
from ..operators.columns import DEFAULT_DROP, align, dedupe, drop_unusable, label_last, prepare_raw
from ..sources.tables import bookings, deterministic_score
from .catalog import register
from .oracle import PREPARED_CTE, with_ctes

BOOKING_COLS = (
    "booking_id", "hotel", "is_canceled", "lead_time", "arrival_date_year", "arrival_date_month",
    "arrival_date_week_number", "arrival_date_day_of_month", "stays_in_weekend_nights",
    "stays_in_week_nights", "adults", "children", "babies", "meal", "country", "market_segment",
    "distribution_channel", "is_repeated_guest", "previous_cancellations", "reserved_room_type",
    "assigned_room_type", "deposit_type", "agent", "company", "customer_type", "adr",
    "total_of_special_requests", "reservation_status", "reservation_status_date",
)


def messy_name(name: str) -> str:
    """Raw-file style header for a clean name: spaced title case, padding and punctuation."""
    return "  " + name.replace("_", " ").title().replace(" ", " - ") + " ?"


@register("clean_names", with_ctes("SELECT * FROM bookings"))
def clean_names(spark, sf_dir):
    raw = bookings(spark, sf_dir)
    messy = raw.toDF(*[messy_name(c) for c in raw.columns])
    return clean_columns(messy)


@register("drop_unusable", with_ctes(
    "SELECT " + ", ".join(c for c in BOOKING_COLS if c not in DEFAULT_DROP) + " FROM bookings"))
def drop_unusable_query(spark, sf_dir):
    return drop_unusable(bookings(spark, sf_dir))


@register("label_last", with_ctes(
    "SELECT " + ", ".join(c for c in BOOKING_COLS if c != "is_canceled")
    + ", is_canceled FROM bookings"))
def label_last_query(spark, sf_dir):
    return label_last(bookings(spark, sf_dir), "is_canceled")


@register("hotel_features", with_ctes("""
SELECT booking_id,
  coalesce(stays_in_weekend_nights, 0) + coalesce(stays_in_week_nights, 0) AS total_nights,
  coalesce(adults, 0) + coalesce(children, 0) + coalesce(babies, 0) AS total_guests,
  CAST(coalesce(children, 0) + coalesce(babies, 0) > 0 AS INT) AS has_children,
  CAST(coalesce(country = 'PRT', false) AS INT) AS is_domestic,
  CAST(coalesce(reserved_room_type <> assigned_room_type, true) AS INT) AS is_room_changed
FROM bookings"""))
def hotel_features_query(spark, sf_dir):
    return hotel_features(bookings(spark, sf_dir)).select(
        "booking_id", "total_nights", "total_guests", "has_children", "is_domestic",
        "is_room_changed")


@register("prepare_raw", with_ctes("SELECT * FROM prepared", PREPARED_CTE))
def prepare_raw_query(spark, sf_dir):
    return prepare_raw(bookings(spark, sf_dir))


ALIGN_TO = ("booking_id", "lead_time", "booking_changes", "total_nights",
            "days_in_waiting_list", "adr", "is_room_changed")


@register("align_columns", with_ctes("""
SELECT CAST(booking_id AS BIGINT) AS booking_id, lead_time, CAST(0 AS DOUBLE) AS booking_changes,
  total_nights, CAST(0 AS DOUBLE) AS days_in_waiting_list, adr, is_room_changed FROM prepared""",
                                     PREPARED_CTE))
def align_columns(spark, sf_dir):
    return align(prepare_raw(bookings(spark, sf_dir)), ALIGN_TO)


DEDUPE_COLS = ("hotel", "meal", "customer_type", "market_segment", "deposit_type", "is_canceled")


@register("dedupe_rows", with_ctes(
    "SELECT DISTINCT " + ", ".join(DEDUPE_COLS) + " FROM bookings"))
def dedupe_rows(spark, sf_dir):
    return dedupe(bookings(spark, sf_dir).select(*DEDUPE_COLS))


@register("dedupe_full_rows", with_ctes(
    "SELECT DISTINCT " + ", ".join(c for c in BOOKING_COLS if c != "booking_id")
    + " FROM bookings"))
def dedupe_full_rows(spark, sf_dir):
    """Duplicates over all raw columns except the row id (the raw job dedupes with the label)."""
    return dedupe(bookings(spark, sf_dir).drop("booking_id"))


@register("label_and_risk", with_ctes("""
SELECT booking_id, prediction,
  CASE WHEN prediction = 1 THEN 'Canceled' ELSE 'Not canceled' END AS label,
  probability,
  CASE WHEN probability IS NULL THEN CASE WHEN prediction = 1 THEN 'High' ELSE 'Low' END
       WHEN probability >= 0.7 THEN 'High' WHEN probability >= 0.4 THEN 'Medium' ELSE 'Low' END
    AS risk_level
FROM (SELECT booking_id, CAST((booking_id % 101) / 100.0 AS DOUBLE) AS probability,
        CAST(CAST((booking_id % 101) / 100.0 AS DOUBLE) >= 0.5 AS INT) AS prediction FROM bookings)"""))
def label_and_risk(spark, sf_dir):
    scored = deterministic_score(bookings(spark, sf_dir).select("booking_id"))
    return scored.select("booking_id", "prediction", label_text("prediction").alias("label"),
                         F.col("score").alias("probability"),
                         risk_level("score", "prediction").alias("risk_level"))
