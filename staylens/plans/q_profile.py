"""Profile queries (table overview, describes, counts, rates, correlation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.features import PROFILE_TEXT_COLS, lenient_double
from ..operators import profile as P
from ..operators.ranks import exact_quantiles
from .catalog import r6, register
from .frames import COUNT_COLS, DESCRIBE_COLS, HEAT_COLS, profile_frame
from .oracle import EDA_COLUMNS, EDA_CTE, union_all, with_ctes

EDA_NAMES = [n for n, _ in EDA_COLUMNS]
DESC_PRESENT = [c for c in DESCRIBE_COLS if c in EDA_NAMES]
TEXT_PRESENT = [c for c in PROFILE_TEXT_COLS if c in EDA_NAMES]
HEAT_PRESENT = [c for c in HEAT_COLS if c in EDA_NAMES]


def _sql(body: str, *extra: str) -> str:
    return with_ctes(body, EDA_CTE, *extra)


# ---------------------------------------------------------------- flagship
@register("cancel_rate_by_segment", _sql("""
SELECT market_segment, round(avg(try_cast(is_canceled AS DOUBLE)), 6) AS cancel_rate
FROM eda WHERE market_segment IS NOT NULL GROUP BY market_segment"""))
def cancel_rate_by_segment(spark, sf_dir):
    rates = P.group_rate(profile_frame(spark, sf_dir), "market_segment", "is_canceled",
                         "cancel_rate")
    return rates.select("market_segment", r6("cancel_rate").alias("cancel_rate"))


# ---------------------------------------------------------------- overview
_kinds = [t for _, t in EDA_COLUMNS]


@register("table_shape", _sql(f"""
SELECT count(*) AS n_rows, {len(EDA_COLUMNS)} AS n_cols,
  {_kinds.count('string')} AS n_text_cols,
  {sum(t in ('int', 'bigint') for t in _kinds)} AS n_int_cols,
  {_kinds.count('double')} AS n_float_cols
FROM eda"""))
def table_shape(spark, sf_dir):
    return P.table_shape(profile_frame(spark, sf_dir))


@register("column_profile", _sql(union_all([
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count({c}) AS n_missing,
  count(DISTINCT {c}) AS n_distinct, count(*) > count({c}) AS has_missing FROM eda"""
    for c, t in EDA_COLUMNS])))
def column_profile(spark, sf_dir):
    prof = P.column_profile(profile_frame(spark, sf_dir))
    return prof.select("column", "dtype", F.col("missing").alias("n_missing"),
                       F.col("distinct").alias("n_distinct"), "has_missing")


@register("missing_ranking", _sql("SELECT * FROM (" + union_all([
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_missing,
  round(CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*), 6) AS pct,
  CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*) > 50.0 AS over_half FROM eda"""
    for c, _ in EDA_COLUMNS]) + ") WHERE n_missing > 0"))
def missing_ranking(spark, sf_dir):
    ranked = P.missing_ranking(profile_frame(spark, sf_dir))
    return ranked.select("column", F.col("missing").alias("n_missing"), r6("pct").alias("pct"),
                         "over_half")


# ---------------------------------------------------------------- describes
@register("numeric_describe", _sql(union_all([
    f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS "min",
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75,
  round(CAST(max({c}) AS DOUBLE), 6) AS "max" FROM eda""" for c in DESC_PRESENT])))
def numeric_describe(spark, sf_dir):
    d = P.numeric_describe(profile_frame(spark, sf_dir), DESCRIBE_COLS)
    return d.select("column", "count", *[r6(c).alias(c) for c in
                                         ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("categorical_describe", _sql(union_all([
    f"""SELECT '{c}' AS "column", count({c}) AS "count", count(DISTINCT {c}) AS "unique",
  (SELECT {c} FROM eda WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
  (SELECT count(*) FROM eda WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq
FROM eda""" for c in TEXT_PRESENT])))
def categorical_describe(spark, sf_dir):
    return P.categorical_describe(profile_frame(spark, sf_dir), PROFILE_TEXT_COLS)


# ---------------------------------------------------------------- single figures
@register("median_lead_by_label", _sql("""
SELECT is_canceled, round(quantile_cont(CAST(lead_time AS DOUBLE), 0.5), 6) AS median_lead_time
FROM eda GROUP BY is_canceled"""))
def median_lead_by_label(spark, sf_dir):
    q = exact_quantiles(profile_frame(spark, sf_dir), ["lead_time"], [0.5], by=["is_canceled"])
    return q.select("is_canceled", r6("value").alias("median_lead_time"))


@register("global_means", _sql("""
SELECT round(avg(lead_time), 6) AS mean_lead_time, round(avg(adr), 6) AS mean_adr FROM eda"""))
def global_means(spark, sf_dir):
    return profile_frame(spark, sf_dir).agg(r6(F.avg("lead_time")).alias("mean_lead_time"),
                                            r6(F.avg("adr")).alias("mean_adr"))


@register("top_modes", _sql(union_all([
    f"""SELECT '{c}' AS "column",
  (SELECT {c} FROM eda WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode"""
    for c in ("hotel", "market_segment")])))
def top_modes(spark, sf_dir):
    return P.modes(profile_frame(spark, sf_dir), ["hotel", "market_segment"])


@register("category_counts", _sql(union_all([
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS "count"
FROM eda WHERE {c} IS NOT NULL GROUP BY {c}""" for c in COUNT_COLS])))
def category_counts(spark, sf_dir):
    return P.value_counts(profile_frame(spark, sf_dir), COUNT_COLS)


@register("top_countries", _sql("""
SELECT country, count(*) AS "count" FROM eda WHERE country IS NOT NULL
GROUP BY country ORDER BY count(*) DESC, country LIMIT 10"""))
def top_countries(spark, sf_dir):
    return P.top_k(profile_frame(spark, sf_dir), "country", 10)


@register("segment_rank_picks", _sql("""
SELECT CASE d WHEN 1 THEN 'first' WHEN 2 THEN 'second' ELSE 'third' END AS pick,
  market_segment, round(cancel_rate, 6) AS cancel_rate FROM ranked WHERE d <= 3
UNION ALL
SELECT 'last' AS pick, market_segment, round(cancel_rate, 6) AS cancel_rate FROM ranked WHERE a = 1""",
"""
rates AS (SELECT market_segment, avg(try_cast(is_canceled AS DOUBLE)) AS cancel_rate
  FROM eda WHERE market_segment IS NOT NULL GROUP BY market_segment)""",
"""
ranked AS (SELECT *, row_number() OVER (ORDER BY cancel_rate DESC, market_segment ASC) AS d,
  row_number() OVER (ORDER BY cancel_rate ASC, market_segment DESC) AS a FROM rates)"""))
def segment_rank_picks(spark, sf_dir):
    rates = P.group_rate(profile_frame(spark, sf_dir), "market_segment", "is_canceled",
                         "cancel_rate")
    picks = P.rank_picks(rates, "market_segment", "cancel_rate")
    return picks.select("pick", "market_segment", r6("cancel_rate").alias("cancel_rate"))


@register("deposit_by_label", _sql("""
SELECT deposit_type, is_canceled, count(*) AS "count" FROM eda
WHERE deposit_type IS NOT NULL AND is_canceled IS NOT NULL GROUP BY deposit_type, is_canceled"""))
def deposit_by_label(spark, sf_dir):
    return P.crosstab_counts(profile_frame(spark, sf_dir), "deposit_type", "is_canceled")


@register("requests_by_label", _sql("""
SELECT total_of_special_requests, is_canceled, count(*) AS "count" FROM eda
WHERE total_of_special_requests IS NOT NULL AND is_canceled IS NOT NULL
GROUP BY total_of_special_requests, is_canceled"""))
def requests_by_label(spark, sf_dir):
    return P.crosstab_counts(profile_frame(spark, sf_dir), "total_of_special_requests",
                             "is_canceled")


@register("non_refund_cancel_rate", _sql("""
SELECT round(avg(CASE WHEN deposit_type = 'Non Refund' THEN try_cast(is_canceled AS DOUBLE) END), 6)
  AS cancel_rate FROM eda"""))
def non_refund_cancel_rate(spark, sf_dir):
    m = P.conditional_mean(profile_frame(spark, sf_dir), "deposit_type", "Non Refund",
                           "is_canceled", "cancel_rate")
    return m.select(r6("cancel_rate").alias("cancel_rate"))


# ---------------------------------------------------------------- correlation
def _corr_sql(lower_only: bool) -> str:
    parts = []
    for i, a in enumerate(HEAT_PRESENT):
        for j, b in enumerate(HEAT_PRESENT):
            if lower_only and not i > j:
                continue
            parts.append(f"""SELECT '{a}' AS row_col, '{b}' AS col_col, {i} AS row_idx, {j} AS col_idx,
  round(corr(try_cast({a} AS DOUBLE), try_cast({b} AS DOUBLE)), 6) AS r FROM eda""")
    return _sql(union_all(parts))


@register("correlation_matrix", _corr_sql(False))
def correlation_matrix(spark, sf_dir):
    c = P.correlation_matrix(profile_frame(spark, sf_dir), HEAT_COLS)
    return c.select("row_col", "col_col", "row_idx", "col_idx", r6("r").alias("r"))


@register("correlation_lower", _corr_sql(True))
def correlation_lower(spark, sf_dir):
    c = P.lower_triangle(P.correlation_matrix(profile_frame(spark, sf_dir), HEAT_COLS))
    return c.select("row_col", "col_col", "row_idx", "col_idx", r6("r").alias("r"))


# ---------------------------------------------------------------- profile frame itself
@register("profile_features", _sql("""
SELECT booking_id, is_canceled, arrival_date_year, is_repeated_guest, total_nights,
  total_guests, has_requests, try_cast(is_canceled AS DOUBLE) AS is_canceled_num FROM eda"""))
def profile_features_query(spark, sf_dir):
    df = profile_frame(spark, sf_dir)
    return df.select("booking_id", "is_canceled", "arrival_date_year", "is_repeated_guest",
                     "total_nights", "total_guests", "has_requests",
                     lenient_double(F.col("is_canceled")).alias("is_canceled_num"))
