"""Distribution queries: quantile trim, box statistics, histogram, density curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import distribution as D
from .catalog import r6, register
from .frames import BOX_COLS, HIST_COLS, profile_frame
from .oracle import EDA_CTE, with_ctes

POINTS, HIST_BINS = 200, 30


def _sql(body: str, *extra: str) -> str:
    return with_ctes(body, EDA_CTE, *extra)


def _long_ctes(cols, by: str = "") -> tuple[str, str, str]:
    sel = ", ".join([*([by] if by else []), *[f"CAST({c} AS DOUBLE) AS {c}" for c in cols]])
    return (f"""
long AS (SELECT * FROM (UNPIVOT (SELECT {sel} FROM eda) ON {", ".join(cols)}
  INTO NAME "column" VALUE value))""", """
lim AS (SELECT "column", quantile_cont(value, 0.99) AS lim FROM long GROUP BY "column")""", """
tr AS (SELECT l.* FROM long l JOIN lim ON l."column" = lim."column" WHERE l.value < lim.lim)""")


_RANGE = """CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
  CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi"""


@register("trim_p99_lead_time", _sql("""
SELECT booking_id, lead_time, is_canceled FROM eda
WHERE lead_time < (SELECT quantile_cont(CAST(lead_time AS DOUBLE), 0.99) FROM eda)"""))
def trim_p99_lead_time(spark, sf_dir):
    eda = profile_frame(spark, sf_dir)
    return D.trim_below_quantile(eda, "lead_time", 0.99).select("booking_id", "lead_time",
                                                                  "is_canceled")


@register("box_stats", _sql("""
SELECT f.is_canceled, f."column", round(f.q1, 6) AS q1, round(f.median, 6) AS median,
  round(f.q3, 6) AS q3,
  round(min(CASE WHEN t.value >= f.lo THEN t.value END), 6) AS whisker_low,
  round(max(CASE WHEN t.value <= f.hi THEN t.value END), 6) AS whisker_high,
  count(*) FILTER (WHERE t.value < f.lo OR t.value > f.hi) AS n_outliers, f.n
FROM f JOIN tr t ON t.is_canceled = f.is_canceled AND t."column" = f."column"
GROUP BY f.is_canceled, f."column", f.q1, f.median, f.q3, f.n""",
    *_long_ctes(BOX_COLS, "is_canceled"), """
qs AS (SELECT is_canceled, "column", quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3, count(*) AS n
  FROM tr GROUP BY is_canceled, "column")""", """
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM qs)"""))
def box_stats(spark, sf_dir):
    b = D.box_stats(profile_frame(spark, sf_dir), BOX_COLS, ["is_canceled"])
    return b.select("is_canceled", "column",
                    *[r6(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
                    "n_outliers", "n")


@register("histogram", _sql(f"""
SELECT a."column", a.bin, round(a.lo + a.bin * ((a.hi - a.lo) / {float(HIST_BINS)}), 6) AS bin_lo,
  round(a.lo + (a.bin + 1) * ((a.hi - a.lo) / {float(HIST_BINS)}), 6) AS bin_hi,
  coalesce(c.c, 0) AS "count"
FROM allb a LEFT JOIN cnt c ON a."column" = c."column" AND a.bin = c.bin""",
    *_long_ctes(HIST_COLS), f"""
rng AS (SELECT "column", {_RANGE} FROM tr GROUP BY "column")""", f"""
cnt AS (SELECT t."column",
  CAST(least(floor((t.value - r.lo) / (r.hi - r.lo) * {float(HIST_BINS)}), {HIST_BINS - 1}) AS INT) AS bin,
  count(*) AS c FROM tr t JOIN rng r ON t."column" = r."column" GROUP BY 1, 2)""", f"""
allb AS (SELECT r."column", r.lo, r.hi, b.bin FROM rng r,
  (SELECT CAST(range AS INT) AS bin FROM range({HIST_BINS})) b)"""))
def histogram(spark, sf_dir):
    h = D.histogram(profile_frame(spark, sf_dir), HIST_COLS, HIST_BINS)
    return h.select("column", "bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"),
                    "count")


def _density_sql(keys: list[str], grid: tuple[float, float] | None) -> tuple[str, str, str]:
    """Every grid point against every row."""
    k = ", ".join(keys)
    on = " AND ".join(f"g.{c} IS NOT DISTINCT FROM t.{c}" for c in keys)
    glo, ghi = (f"CAST({v} AS DOUBLE)" for v in grid) if grid else ("s.lo", "s.hi")
    body = f"""
SELECT {", ".join("g." + c for c in keys)}, g.point, round(g.x, 6) AS x,
  round(sum(t.c * exp(-0.5 * pow((g.x - t.value) / g.bw, 2))) / (g.n * g.bw * sqrt(2 * pi())), 6) AS density
FROM grid g JOIN (SELECT {k}, value, count(*) AS c FROM src GROUP BY ALL) t ON {on}
GROUP BY {", ".join("g." + c for c in keys)}, g.point, g.x, g.n, g.bw"""
    return (body, f"""
st AS (SELECT {k}, count(*) AS n, stddev_samp(value) AS sd, {_RANGE} FROM src GROUP BY {k})""", f"""
grid AS (SELECT {", ".join("s." + c for c in keys)}, p.point,
  {glo} + p.point * ({ghi} - {glo}) / {float(POINTS - 1)} AS x,
  s.sd * pow(CAST(s.n AS DOUBLE), -0.2) AS bw, s.n
  FROM st s, (SELECT CAST(range AS INT) AS point FROM range({POINTS})) p)""")


_kb, *_kc = _density_sql(['"column"'], None)


@register("density_curve", _sql(_kb, *_long_ctes(HIST_COLS), "\nsrc AS (SELECT * FROM tr)", *_kc))
def density_curve(spark, sf_dir):
    d = D.density(profile_frame(spark, sf_dir), HIST_COLS, POINTS)
    return d.select("column", "point", r6("x").alias("x"), r6("density").alias("density"))


_lb, *_lc = _density_sql(["is_canceled", '"column"'], (0.0, 400.0))


@register("lead_time_density_by_label", _sql(_lb, """
src AS (SELECT is_canceled, 'lead_time' AS "column", CAST(lead_time AS DOUBLE) AS value
  FROM eda WHERE lead_time IS NOT NULL)""", *_lc))
def lead_time_density_by_label(spark, sf_dir):
    d = D.density_by(profile_frame(spark, sf_dir), "lead_time", ["is_canceled"], 0.0, 400.0, POINTS)
    return d.select("is_canceled", "column", "point", r6("x").alias("x"),
                    r6("density").alias("density"))


OUTLIER = 1e6


_ob, *_oc = _density_sql(['"column"'], (0.0, 1000.0))


@register("density_with_outlier", _sql(_ob, f"""
src AS (SELECT 'lead_time' AS "column", CAST(CASE WHEN booking_id = m THEN {OUTLIER} ELSE lead_time END AS DOUBLE) AS value
  FROM eda, (SELECT min(booking_id) AS m FROM eda) WHERE lead_time IS NOT NULL OR booking_id = m)""", *_oc))
def density_with_outlier(spark, sf_dir):
    """The curve of the bulk of the values is not coarser for one value far away."""
    eda = profile_frame(spark, sf_dir).select("booking_id", F.col("lead_time").cast("double").alias("lead_time"))
    first = F.col("booking_id") == eda.select(F.min("booking_id")).scalar()
    far = eda.select(F.when(first, F.lit(OUTLIER)).otherwise(F.col("lead_time")).alias("lead_time"))
    d = D.density_by(far, "lead_time", [], 0.0, 1000.0, POINTS)
    return d.select("column", "point", r6("x").alias("x"), r6("density").alias("density"))
