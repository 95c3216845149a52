"""Derived booking columns as plain column expressions (no UDF, one projection).

Two feature families exist on purpose, with different null rules:

* model features (:func:`hotel_features`): a missing count is 0;
* profile features (:func:`profile_features`): ``total_nights`` stays null
  when an input is null, only ``children`` is treated as 0.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DoubleType, FloatType, IntegralType, NumericType,
                               StringType, TimestampType)
from .names import qcol

STAY_COLS = ("stays_in_weekend_nights", "stays_in_week_nights")
GUEST_COLS = ("adults", "children", "babies")
HOME_COUNTRY = "PRT"

# Columns the profile casts to text when present.
PROFILE_TEXT_COLS = (
    "hotel", "is_canceled", "arrival_date_year", "arrival_date_month", "meal",
    "country", "market_segment", "distribution_channel", "is_repeated_guest",
    "reserved_room_type", "assigned_room_type", "deposit_type", "agent",
    "company", "customer_type", "reservation_status",
    "name", "email", "phone-number", "credit_card",
)


def _zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def hotel_features(df: DataFrame, home_country: str = HOME_COUNTRY,
                   reserved_col: str = "reserved_room_type",
                   assigned_col: str = "assigned_room_type") -> DataFrame:
    """Model features; each group is made only when all its inputs exist.

    total_nights, total_guests, has_children replace their inputs; is_domestic
    replaces the country; is_room_changed keeps both room columns (the drop
    step removes the assigned one later).  New columns are appended in that
    order, as one projection.
    """
    cols = list(df.columns)
    out: list[Column] = []
    drop: set[str] = set()
    if set(STAY_COLS) <= set(cols):
        out.append(sum((_zero_if_null(c) for c in STAY_COLS[1:]),
                       _zero_if_null(STAY_COLS[0])).alias("total_nights"))
        drop.update(STAY_COLS)
    if set(GUEST_COLS) <= set(cols):
        out.append((_zero_if_null("adults") + _zero_if_null("children")
                    + _zero_if_null("babies")).alias("total_guests"))
        out.append(((_zero_if_null("children") + _zero_if_null("babies")) > 0)
                   .cast("int").alias("has_children"))
        drop.update(GUEST_COLS)
    if "country" in cols:
        out.append(F.coalesce(F.col("country") == F.lit(home_country), F.lit(False))
                   .cast("int").alias("is_domestic"))
        drop.add("country")
    if {reserved_col, assigned_col} <= set(cols):
        # A missing room on either side counts as a change.
        out.append(F.coalesce(F.col(reserved_col) != F.col(assigned_col), F.lit(True))
                   .cast("int").alias("is_room_changed"))
    kept = [qcol(c) for c in cols if c not in drop]
    return df.select(*kept, *out)


def profile_features(df: DataFrame) -> DataFrame:
    """Profile-time columns: total_nights (null-propagating), total_guests, has_requests.

    Each is added only when its inputs exist.
    """
    have = set(df.columns)
    extra = []
    if set(STAY_COLS) <= have:
        extra.append((F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights"))
                     .alias("total_nights"))
    if set(GUEST_COLS) <= have:
        extra.append((F.col("adults") + F.coalesce(F.col("children"), F.lit(0.0)) + F.col("babies"))
                     .alias("total_guests"))
    if "total_of_special_requests" in have:
        extra.append(F.coalesce(F.col("total_of_special_requests") > 0, F.lit(False))
                     .alias("has_requests"))
    return df.select("*", *extra)


def as_text(df: DataFrame, cols: Iterable[str] = PROFILE_TEXT_COLS) -> DataFrame:
    """Cast the listed columns that exist to string; null stays null."""
    wanted = set(cols)
    return df.select(*[(qcol(c).cast("string") if c in wanted else qcol(c)).alias(c)
                       for c in df.columns])


def lenient_double(col: Column | str) -> Column:
    """String or number to double; text that is not a number becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("double")


# Text that a pandas CSV reader turns into a missing value by default.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def text_or_null(c: Column) -> Column:
    """Text, but null for the tokens of a missing value."""
    return F.when(c.isin(*NA_TOKENS), F.lit(None)).otherwise(c)


def as_type(c: Column, found: DataType, wanted: str) -> Column:
    """A raw value as the wanted type: NA tokens and text that does not parse are null, 2.0 is a whole number."""
    if isinstance(found, StringType):
        c = text_or_null(c)
    if found.simpleString() == wanted:
        return c
    if wanted in ("tinyint", "smallint", "int", "bigint", "long") and not isinstance(found, (DateType, TimestampType, BooleanType)):
        number = c.try_cast("double")
        return F.coalesce(c.try_cast(wanted) if isinstance(found, (StringType, IntegralType)) else F.lit(None),
                          F.when(number == F.floor(number), number).try_cast(wanted))
    return c.try_cast(wanted)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark keeps NaN as a value; the model treats it as missing like null."""
    exprs = []
    for f in df.schema.fields:
        c = qcol(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c)
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def is_numeric_type(dtype) -> bool:
    """The two column kinds: numbers and booleans vs everything else."""
    return isinstance(dtype, (NumericType, BooleanType))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType) and f.name not in skip]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if not is_numeric_type(f.dataType) and f.name not in skip]
