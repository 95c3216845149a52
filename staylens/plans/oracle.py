"""DuckDB oracle SQL for the registered queries.

Every statement starts from the same ``bookings`` view text as the Spark
source (``staylens.sources.tables.bookings``) over the driver's parquet
views, then states the operator's result in plain SQL.  Floating results
are rounded to 6 places on both sides.
"""

from __future__ import annotations

BOOKINGS_CTES = """
li AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_linenumber % 3) AS n_wk,
         min(l_shipdate) AS first_ship, min(l_returnflag) AS rf_min, max(l_returnflag) AS rf_max
  FROM lineitem GROUP BY l_orderkey),
bookings AS (
SELECT o.o_orderkey AS booking_id,
  CASE WHEN n.n_regionkey < 3 THEN 'City Hotel' ELSE 'Resort Hotel' END AS hotel,
  CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_canceled,
  CAST(abs(datediff('day', o.o_orderdate, li.first_ship)) AS INT) AS lead_time,
  CAST(year(o.o_orderdate) AS INT) AS arrival_date_year,
  CAST(month(o.o_orderdate) AS STRING) AS arrival_date_month,
  CAST(weekofyear(o.o_orderdate) AS INT) AS arrival_date_week_number,
  CAST(day(o.o_orderdate) AS INT) AS arrival_date_day_of_month,
  CAST(li.n_wk AS INT) AS stays_in_weekend_nights,
  CAST(li.n_lines AS INT) AS stays_in_week_nights,
  CAST(1 + o.o_orderkey % 3 AS INT) AS adults,
  CAST(nullif(o.o_orderkey % 5, 4) AS DOUBLE) AS children,
  CAST(o.o_orderkey % 2 AS INT) AS babies,
  substring(o.o_orderpriority, 1, 1) AS meal,
  CASE n.n_nationkey WHEN 0 THEN 'PRT' WHEN 1 THEN NULL ELSE n.n_name END AS country,
  nullif(c.c_mktsegment, 'MACHINERY') AS market_segment,
  o.o_orderpriority AS distribution_channel,
  CAST(c.c_custkey % 2 AS INT) AS is_repeated_guest,
  CAST(o.o_orderkey % 4 AS INT) AS previous_cancellations,
  li.rf_min AS reserved_room_type, li.rf_max AS assigned_room_type,
  CASE WHEN c.c_acctbal < 0 THEN 'Non Refund' WHEN c.c_acctbal < 1000 THEN 'Refundable' ELSE 'No Deposit' END AS deposit_type,
  CAST(nullif(o.o_custkey % 10, 0) AS STRING) AS agent,
  CAST(NULL AS STRING) AS company,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'Transient' WHEN 1 THEN 'Group' ELSE 'Contract' END AS customer_type,
  o.o_totalprice / 1000 AS adr,
  CAST(o.o_orderkey % 6 AS INT) AS total_of_special_requests,
  o.o_orderstatus AS reservation_status, o.o_orderdate AS reservation_status_date
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN li ON li.l_orderkey = o.o_orderkey)"""

# Profile view: text categories and the profile-time features.
EDA_CTE = """
eda AS (
  SELECT booking_id, hotel, CAST(is_canceled AS VARCHAR) AS is_canceled, lead_time,
    CAST(arrival_date_year AS VARCHAR) AS arrival_date_year, arrival_date_month,
    arrival_date_week_number, arrival_date_day_of_month, stays_in_weekend_nights,
    stays_in_week_nights, adults, children, babies, meal, country, market_segment,
    distribution_channel, CAST(is_repeated_guest AS VARCHAR) AS is_repeated_guest,
    previous_cancellations, reserved_room_type, assigned_room_type, deposit_type, agent,
    company, customer_type, adr, total_of_special_requests, reservation_status,
    reservation_status_date,
    stays_in_weekend_nights + stays_in_week_nights AS total_nights,
    adults + coalesce(children, 0.0) + babies AS total_guests,
    coalesce(total_of_special_requests > 0, false) AS has_requests
  FROM bookings)"""

# (name, Spark simple type) of the profile view, in column order.
EDA_COLUMNS = (
    ("booking_id", "bigint"), ("hotel", "string"), ("is_canceled", "string"),
    ("lead_time", "int"), ("arrival_date_year", "string"), ("arrival_date_month", "string"),
    ("arrival_date_week_number", "int"), ("arrival_date_day_of_month", "int"),
    ("stays_in_weekend_nights", "int"), ("stays_in_week_nights", "int"), ("adults", "int"),
    ("children", "double"), ("babies", "int"), ("meal", "string"), ("country", "string"),
    ("market_segment", "string"), ("distribution_channel", "string"),
    ("is_repeated_guest", "string"), ("previous_cancellations", "int"),
    ("reserved_room_type", "string"), ("assigned_room_type", "string"),
    ("deposit_type", "string"), ("agent", "string"), ("company", "string"),
    ("customer_type", "string"), ("adr", "double"), ("total_of_special_requests", "int"),
    ("reservation_status", "string"), ("reservation_status_date", "timestamp_ntz"),
    ("total_nights", "int"), ("total_guests", "double"), ("has_requests", "boolean"),
)


def with_ctes(body: str, *extra: str) -> str:
    ctes = ",".join([BOOKINGS_CTES, *extra])
    return f"WITH {ctes}\n{body}"


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)

# Model features of the bookings view, then the default drop list.
PREPARED_CTE = """
prepared AS (
  SELECT booking_id, hotel, is_canceled, lead_time, arrival_date_month, arrival_date_week_number,
    arrival_date_day_of_month, meal, market_segment, distribution_channel, is_repeated_guest,
    previous_cancellations, reserved_room_type, deposit_type, customer_type, adr,
    total_of_special_requests,
    coalesce(stays_in_weekend_nights, 0) + coalesce(stays_in_week_nights, 0) AS total_nights,
    coalesce(adults, 0) + coalesce(children, 0) + coalesce(babies, 0) AS total_guests,
    CAST(coalesce(children, 0) + coalesce(babies, 0) > 0 AS INT) AS has_children,
    CAST(coalesce(country = 'PRT', false) AS INT) AS is_domestic,
    CAST(coalesce(reserved_room_type <> assigned_room_type, true) AS INT) AS is_room_changed
  FROM bookings)"""

PREPARED_NUMERIC = ("lead_time", "arrival_date_week_number", "arrival_date_day_of_month",
                    "is_repeated_guest", "previous_cancellations", "adr",
                    "total_of_special_requests", "total_nights", "total_guests",
                    "has_children", "is_domestic", "is_room_changed")
PREPARED_TEXT = ("hotel", "arrival_date_month", "meal", "market_segment",
                 "distribution_channel", "reserved_room_type", "deposit_type", "customer_type")


def split_ctes(source: str, label: str, key: str, test_size: float = 0.3, folds: int = 5,
               seed: int = 42) -> tuple[str, ...]:
    """Rank rows per label by the 52-bit md5 hash of the key, then tag test rows and folds."""
    return (f"""
hashed AS (SELECT *, CAST(('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 13)) AS BIGINT) AS h
  FROM {source})""", f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY h, {key}) - 1 AS rk,
  count(*) OVER (PARTITION BY {label}) AS nc FROM hashed)""", f"""
tagged AS (SELECT *, CASE WHEN rk < floor(CAST({float(test_size)!r} AS DOUBLE) * nc + 0.5) THEN 'test' ELSE 'train' END AS part,
  CASE WHEN rk >= floor(CAST({float(test_size)!r} AS DOUBLE) * nc + 0.5)
    THEN CAST(floor((rk - floor(CAST({float(test_size)!r} AS DOUBLE) * nc + 0.5)) * {folds}
                    / (nc - floor(CAST({float(test_size)!r} AS DOUBLE) * nc + 0.5))) AS INT) END AS fold
  FROM ranked)""")
