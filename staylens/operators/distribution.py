"""Distribution tables behind box plots, histograms and density curves.

The wanted columns are written once, as doubles; every pass unpivots that
narrow table, so several columns share one scan and every column is its own
group.  Per-group statistics (quantile limits, ranges, fences) are small
tables joined back by key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import long_values, narrow, quantiles, same_keys, scalar_quantile
from ..functions.names import qcol

#: Cells of a bandwidth, and bandwidths beyond which a value adds nothing (exp(-8.5^2 / 2) is 2e-16).
CELLS, REACH = 8, 8.5
#: Terms of a cell's expansion: the next one is below 1e-16 of the kernel's top.
TERMS = 10


def trim_below_quantile(df: DataFrame, col: str, q: float = 0.99, method: str = "exact") -> DataFrame:
    """Rows with ``col`` strictly below its q-quantile (a scalar subquery, one plan)."""
    return df.where(qcol(col) < scalar_quantile(df, col, q, method))


def trimmed_long(table: DataFrame, cols: Sequence[str], by: Sequence[str] = (), q: float = 0.99,
                 rows: int | None = None) -> DataFrame:
    """(by, column, value) of a :func:`narrow` table: per column, values below its q-quantile over all rows."""
    limits = quantiles(long_values(table, cols), ["column"], [q], table.count() if rows is None else rows)
    met = same_keys(long_values(table, cols, by), limits.select("column", F.col("value").alias("_lim")), ["column"])
    return met.where(F.col("value") < F.col("_lim")).drop("_lim")


def box_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str], q: float = 0.99,
              whisker: float = 1.5) -> DataFrame:
    """q1, median, q3, whiskers (furthest values inside q1/q3 -/+ whisker*IQR), outliers, n."""
    by = list(by)
    keys = [*by, "column"]
    table = narrow(df, cols, by)
    rows = table.count()
    long = trimmed_long(table, cols, by, q, rows)
    found = quantiles(long, keys, [0.25, 0.5, 0.75], rows)
    fences = found.groupBy(*keys).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                        for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    iqr = F.col("q3") - F.col("q1")
    fences = fences.withColumns({"_lo": F.col("q1") - F.lit(whisker) * iqr, "_hi": F.col("q3") + F.lit(whisker) * iqr})
    v = F.col("value")
    return same_keys(long, fences, keys).groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(v >= F.col("_lo"), v)).alias("whisker_low"),
        F.max(F.when(v <= F.col("_hi"), v)).alias("whisker_high"),
        F.count_if((v < F.col("_lo")) | (v > F.col("_hi"))).alias("n_outliers"), F.count("*").alias("n"))


def _range_cols(mn: Column, mx: Column) -> tuple[Column, Column]:
    """A zero-width range widens to +-0.5, as histogram edges do."""
    same = mn == mx
    return (F.when(same, mn - 0.5).otherwise(mn), F.when(same, mx + 0.5).otherwise(mx))


def _bin_of(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    return F.least(F.floor((v - lo) / (hi - lo) * F.lit(float(bins))),
                   F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30, q: float = 0.99,
              trim: bool = True) -> DataFrame:
    """Equal-width bins over each column's [min, max] (after the quantile trim), empty bins kept."""
    table = narrow(df, cols)
    long = trimmed_long(table, cols, (), q) if trim else long_values(table, cols)
    lo, hi = _range_cols(F.min("value"), F.max("value"))
    rng = long.groupBy("column").agg(lo.alias("_lo"), hi.alias("_hi"))
    counted = (same_keys(long, rng, ["column"])
               .withColumn("bin", _bin_of(F.col("value"), F.col("_lo"), F.col("_hi"), bins))
               .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count")))
    every = rng.select("column", "_lo", "_hi",
                       F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return (every.join(counted, ["column", "bin"], "left")
            .select("column", "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def _hermite() -> list[list[int]]:
    """Coefficients (by rising power) of the polynomials He_0, He_1, ... of a Gaussian's expansion."""
    polynomials = [[1], [0, 1]]
    while len(polynomials) < TERMS:
        k = len(polynomials) - 1
        shifted = [0, *polynomials[k]]
        polynomials.append([a - k * b for a, b in zip(shifted, polynomials[k - 1] + [0, 0])])
    return polynomials


def density_points(long: DataFrame, keys: Sequence[str], points: int = 200, grid_lo: float | None = None,
                   grid_hi: float | None = None) -> DataFrame:
    """(keys, point, x, density): Gaussian density (Scott bandwidth: sample std * n^(-1/5)) on an even grid.

    Values are gathered into cells of 1/8 bandwidth, and a cell keeps the sums
    of the powers of its values' distances to its centre.  These are the
    coefficients of the cell's share of any point's density, so a cell adds to
    each grid point within 8.5 bandwidths exactly what its rows would, to
    double precision.  Only cells that hold values exist, however wide the
    range.  A curve over its whole range integrates to 1; a constant column
    has a null density.
    """
    keys = list(keys)
    lo, hi = _range_cols(F.min("value"), F.max("value"))
    stats = long.groupBy(*keys).agg(F.count("*").alias("_n"), F.stddev_samp("value").alias("_sd"), lo.alias("_lo"),
                                    hi.alias("_hi"))
    stats = stats.select(*keys, "_n", F.nullif(F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)),
                                               F.lit(0.0)).alias("_bw"),
                         (F.lit(float(grid_lo)) if grid_lo is not None else F.col("_lo")).alias("_glo"),
                         (F.lit(float(grid_hi)) if grid_hi is not None else F.col("_hi")).alias("_ghi"))
    step = (F.col("_ghi") - F.col("_glo")) / F.lit(float(points - 1))
    cell = F.floor(F.col("value") / F.col("_bw") * CELLS).cast("long")
    near = same_keys(long, stats.where(F.col("_bw").isNotNull()), keys)
    near = near.select(*keys, "_bw", "_glo", step.alias("_step"), cell.alias("_cell"),
                       (F.col("value") / F.col("_bw") - (cell + 0.5) / CELLS).alias("_s"))
    powers = [F.lit(1.0)]
    for _ in range(1, TERMS):
        powers.append(powers[-1] * F.col("_s"))
    cells = near.groupBy(*keys, "_bw", "_glo", "_step", "_cell").agg(*[F.sum(p).alias(f"_m{k}") for k, p in enumerate(powers)])
    # sum_k He_k(u) m_k / k! as one polynomial in u, the distance of a point in bandwidths.
    hermite = _hermite()
    for j in range(TERMS):
        terms = [F.col(f"_m{k}") * (hermite[k][j] / math.factorial(k)) for k in range(j, TERMS) if hermite[k][j]]
        cells = cells.withColumn(f"_a{j}", sum(terms[1:], terms[0]))
    centre = (F.col("_cell") + 0.5) / CELLS
    first = F.ceil(((centre - REACH) * F.col("_bw") - F.col("_glo")) / F.col("_step"))
    last = F.floor(((centre + REACH) * F.col("_bw") - F.col("_glo")) / F.col("_step"))
    first, last = F.greatest(first, F.lit(0)).cast("int"), F.least(last, F.lit(points - 1)).cast("int")
    reached = F.when(first <= last, F.sequence(first, last))
    u = (F.col("_glo") + F.col("point") * F.col("_step")) / F.col("_bw") - centre
    added = cells.select("*", F.explode(reached).alias("point")).withColumn("_u", u)
    total = F.col(f"_a{TERMS - 1}")
    for j in range(TERMS - 2, -1, -1):
        total = total * F.col("_u") + F.col(f"_a{j}")
    sums = added.groupBy(*keys, "point").agg(F.sum(F.exp(F.col("_u") * F.col("_u") * -0.5) * total).alias("_sum"))
    grid = stats.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    norm = F.col("_n") * F.col("_bw") * F.lit(math.sqrt(2 * math.pi))
    return same_keys(grid, sums, [*keys, "point"], "left").select(
        *keys, "point", (F.col("_glo") + F.col("point") * step).alias("x"),
        F.when(F.col("_bw").isNotNull(), F.coalesce("_sum", F.lit(0.0)) / norm).alias("density"))


def density(df: DataFrame, cols: Sequence[str], points: int = 200, q: float = 0.99, trim: bool = True) -> DataFrame:
    """Density curve per column over its trimmed range (the line over a histogram)."""
    table = narrow(df, cols)
    long = trimmed_long(table, cols, (), q) if trim else long_values(table, cols)
    return density_points(long, ["column"], points)


def density_by(df: DataFrame, col: str, by: Sequence[str], lo: float = 0.0, hi: float = 400.0,
               points: int = 200) -> DataFrame:
    """Density of one column per group, each normalised to 1, on a fixed [lo, hi] grid."""
    return density_points(long_values(narrow(df, [col], by), [col], by), [*by, "column"], points, lo, hi)
