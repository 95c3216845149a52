"""Order statistics of any numeric column, without a task that holds a column.

* :func:`values_at` -- exact values at ranks: a mergeable quantile sketch per
  key gives splitters, the range between two splitters that holds a rank is
  located, and this is repeated inside the range until it is small; then its
  distinct values are counted and ranked.  Splitters follow the data, so far
  outliers, dense clusters and wide integers make no difference;
* :func:`quantiles` / :func:`exact_quantiles` -- linear-interpolation
  quantiles of numeric columns by :func:`values_at`;
* :func:`running_sums` -- sums over all earlier rows of a key in value order:
  rows are dealt into ranges of equal size, sums run inside a range, and the
  ranges' own sums are added up on a table of one row per range and key.

Results are exact, but for quantiles of the ``approx`` method.  Keys may be
null: a null key is a key of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import qcol
from ..session import stored

#: Splitters of a sketch, and the inverse of its relative error.
GRID, ACCURACY = 512, 2_000
#: Share of a key's rows kept away from a rank on each side: four times the sketch's error.
MARGIN = 4 / ACCURACY
#: A round leaves at most this share of a key's rows between the splitters of a rank.
LEFT = 2 / GRID + 4 * MARGIN
#: Rows of a located range that one task may rank.
SMALL = 1_000_000


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
              condition: Callable[[], Column] | None = None) -> DataFrame:
    """Join on ``keys`` where nulls are equal; the columns of ``left``, then the others of ``right``."""
    other = right.select(*[qcol(k).alias(f"_same{i}") for i, k in enumerate(keys)],
                         *[qcol(c) for c in right.columns if c not in keys])
    on = [qcol(k).eqNullSafe(F.col(f"_same{i}")) for i, k in enumerate(keys)]
    on += [condition()] if condition else []
    return left.join(other, reduce(Column.__and__, on), how).drop(*[f"_same{i}" for i in range(len(keys))])


def narrow(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by`` and the numeric columns as doubles, written once: what several passes read."""
    return stored(df.select(*[qcol(c) for c in by], *[qcol(c).cast("double").alias(c) for c in cols if c not in by]),
                  "narrow")


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, value) of the values that are neither null nor NaN."""
    casted = df.select(*[qcol(c) for c in by], *[qcol(c).cast("double").alias(c) for c in cols])
    return (casted.unpivot([qcol(c) for c in by], [qcol(c) for c in cols], "column", "value")
            .where(F.col("value").isNotNull() & ~F.isnan("value")))


def _between(state: DataFrame, first: Column, last: Column, n: Column) -> DataFrame:
    """``lo`` and ``hi``: values of the sketch that are surely not after ``first`` and not before ``last``."""
    i = F.floor((first / n - MARGIN) * GRID).cast("int")
    j = F.ceil(((last + 1) / n + MARGIN) * GRID).cast("int")
    return state.withColumns({
        "lo": F.when(i < 0, F.col("least")).otherwise(F.get("grid", i)),
        "hi": F.when(j > GRID, F.col("most")).otherwise(F.get("grid", j))}).drop("grid", "least", "most")


def _sketch(value: Column) -> list[Column]:
    return [F.percentile_approx(value, [k / GRID for k in range(GRID + 1)], ACCURACY).alias("grid"),
            F.min(value).alias("least"), F.max(value).alias("most")]


def values_at(long: DataFrame, keys: Sequence[str], aims: Callable[[Column], Column], rows: int) -> DataFrame:
    """Exact values at ranks of each key of a (keys, value) frame that is cheap to scan.

    Values are doubles, or integers that a double holds exactly (the sketch works on doubles).

    ``aims`` makes, from a key's number of rows, an array of structs (id, first,
    last): 0-based ranks, which may be equal, in ascending value order.  ``rows``
    (the frame's rows, or more) says how many rounds it takes until a located
    range is small.  Returns (keys, id, first, last, n, v_first, v_last, below,
    equal): the values at both ranks, and the rows of the key that are smaller
    than the first one and equal to it.
    """
    keys = list(keys)
    target = [*keys, "id", "first", "last", "n"]
    value = F.col("value")
    state = long.groupBy(*keys).agg(F.count("*").alias("n"), *_sketch(value))
    state = state.withColumn("aim", F.explode(aims(F.col("n")))).select("*", "aim.*").drop("aim")
    # One row per key and rank, as a table: its measured size decides whether it is broadcast.
    state = stored(_between(state, F.col("first"), F.col("last"), F.col("n")), "located")
    while (rows := rows * LEFT) > SMALL:
        inside = F.when(value >= F.col("lo"), value)
        state = same_keys(long, state, keys, condition=lambda: value <= F.col("hi")).groupBy(*target).agg(
            F.count_if(value < F.col("lo")).alias("below"), F.count(inside).alias("m"), *_sketch(inside))
        state = stored(_between(state, F.col("first") - F.col("below"), F.col("last") - F.col("below"), F.col("m"))
                       .drop("below", "m"), "located")
    met = same_keys(long, state, keys, condition=lambda: value <= F.col("hi"))
    # All smaller values are one group, the null.
    counts = met.groupBy(*target, F.when(value >= F.col("lo"), value).alias("v")).agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy(*keys, "id").orderBy("v").rowsBetween(Window.unboundedPreceding, -1))
    ranked = counts.withColumn("before", F.coalesce(before, F.lit(0)))

    def at(rank: str, what: str) -> Column:
        covers = (F.col("before") <= F.col(rank)) & (F.col(rank) < F.col("before") + F.col("c"))
        return F.max(F.when(covers, F.col(what)))

    return ranked.groupBy(*target).agg(at("first", "v").alias("v_first"), at("last", "v").alias("v_last"),
                                       at("first", "before").alias("below"), at("first", "c").alias("equal"))


def quantiles(long: DataFrame, keys: Sequence[str], probs: Sequence[float], rows: int) -> DataFrame:
    """(keys, prob, value): linear-interpolation quantiles of a (keys, value) frame that is cheap to scan.

    With n values and h = (n - 1) p the result is v[floor h] + (h - floor h) (v[ceil h] - v[floor h]),
    and the value itself where both are equal (so also for infinities).
    """
    def aims(n: Column) -> Column:
        h = [(n - 1).cast("double") * F.lit(float(p)) for p in probs]
        return F.array(*[F.struct(F.lit(float(p)).alias("id"), F.floor(x).cast("long").alias("first"),
                                  F.ceil(x).cast("long").alias("last")) for p, x in zip(probs, h)])

    found = values_at(long, keys, aims, rows)
    part = (F.col("n") - 1).cast("double") * F.col("id") - F.col("first")
    step = F.when(F.col("v_last") == F.col("v_first"), F.lit(0.0)).otherwise(part * (F.col("v_last") - F.col("v_first")))
    return found.select(*keys, F.col("id").alias("prob"), (F.col("v_first") + step).alias("value"))


def approximate_quantiles(long: DataFrame, keys: Sequence[str], probs: Sequence[float],
                          accuracy: int = 10_000) -> DataFrame:
    """(keys, prob, value) from the sketch alone: one pass."""
    probs = [float(p) for p in probs]
    per = long.groupBy(*keys).agg(F.percentile_approx("value", probs, accuracy).alias("q"))
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("q").alias("value"))
    return per.select(*keys, F.explode(pairs).alias("z")).select(*keys, "z.prob", "z.value")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    method: str = "exact") -> DataFrame:
    """Quantiles per (by, column): (by, column, prob, value); a column without values gives no row.

    Same rule as pandas ``quantile`` and DuckDB ``quantile_cont``.  One path for
    all numeric types; ``method="approx"`` takes the sketch's values instead.
    """
    by = list(by)
    if method == "approx":
        return approximate_quantiles(long_values(df, cols, by), [*by, "column"], probs)
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")
    table = narrow(df, cols, by)
    return quantiles(long_values(table, cols, by), [*by, "column"], probs, table.count())


def scalar_quantile(df: DataFrame, col: str, prob: float, method: str = "exact") -> Column:
    """A scalar subquery holding one quantile of ``col``."""
    return exact_quantiles(df, [col], [prob], method=method).select("value").scalar()


def running_sums(rows: DataFrame, keys: Sequence[str], value: str, sums: Sequence[str], descending: bool = False,
                 with_next: bool = False, ranges: int | None = None) -> DataFrame:
    """Adds ``<s>_before`` (sum of ``s`` over the key's earlier rows) and ``<s>_total`` (over all its rows).

    ``rows`` must be distinct on (keys, value); the order is that of ``value``.
    Rows are dealt into ranges of equal size by sampled splitters of (keys,
    value), so a key with most rows, or values massed at a point, are spread
    alike.  The sorted ranges are written once; per range and key the sums are
    added up and carried to the later ranges.  With ``with_next`` also
    ``<s>_next``, ``s`` of the key's next row (null for the last).
    """
    keys = list(keys)
    order = F.col(value).desc() if descending else F.col(value).asc()
    by_range = [*[qcol(k) for k in keys], order]
    dealt = rows.repartitionByRange(ranges, *by_range) if ranges else rows.repartitionByRange(*by_range)
    dealt = stored(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    extreme = F.max_by if descending else F.min_by
    parts = dealt.groupBy(*keys, "_range").agg(
        *[F.sum(s).alias(f"_sum_{s}") for s in sums], extreme(F.struct(*sums), F.col(value)).alias("_head"))
    # One row per range and key.
    later = Window.partitionBy(*keys).orderBy("_range") if keys else Window.orderBy("_range")
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    parts = parts.select(
        *keys, "_range", F.lead("_head").over(later).alias("_head"),
        *[F.sum(f"_sum_{s}").over(whole).alias(f"{s}_total") for s in sums],
        *[F.coalesce(F.sum(f"_sum_{s}").over(later.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_off_{s}")
          for s in sums])
    inner = Window.partitionBy(*keys, "_range").orderBy(order)
    met = same_keys(dealt, parts, [*keys, "_range"])
    before = [(F.col(f"_off_{s}") + F.coalesce(F.sum(s).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .alias(f"{s}_before") for s in sums]
    after = [F.coalesce(F.lead(s).over(inner), F.col("_head")[s]).alias(f"{s}_next") for s in sums] if with_next else []
    return met.select(*[qcol(c) for c in rows.columns], *before, *[F.col(f"{s}_total") for s in sums], *after)
