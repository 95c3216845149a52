"""Shared input frames for the registered queries (all derived from the driver tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import as_text, lenient_double, profile_features
from ..sources.tables import bookings

# Columns named by the profile report (only those present are used).
DESCRIBE_COLS = (
    "lead_time", "arrival_date_week_number", "arrival_date_day_of_month",
    "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children",
    "babies", "previous_cancellations", "previous_bookings_not_canceled",
    "booking_changes", "days_in_waiting_list", "adr",
    "required_car_parking_spaces", "total_of_special_requests",
)
HEAT_COLS = (
    "is_canceled", "lead_time", "arrival_date_year", "arrival_date_week_number",
    "adults", "children", "babies", "is_repeated_guest",
    "previous_cancellations", "booking_changes", "days_in_waiting_list", "adr",
    "required_car_parking_spaces", "total_of_special_requests",
)
COUNT_COLS = ("hotel", "arrival_date_month", "market_segment", "customer_type")
BOX_COLS = ("lead_time", "adr", "total_nights")
HIST_COLS = ("lead_time", "adr", "total_nights", "total_guests")


def profile_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings as the profile report sees them: profile features, text categories."""
    return as_text(profile_features(bookings(spark, sf_dir)))


def with_label_number(df: DataFrame, col: str = "is_canceled",
                      name: str = "is_canceled_int") -> DataFrame:
    return df.withColumn(name, lenient_double(F.col(col)))
