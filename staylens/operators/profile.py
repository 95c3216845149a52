"""Column profiling and descriptive aggregation.

Pattern used throughout: unpivot the wanted columns once into
(column, value) rows and aggregate with ``column`` as a grouping key, so
each column is its own group (spread over tasks) and one scan serves all
columns.  Many ``count(distinct)`` in one ``agg`` would instead expand every
row once per distinct aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType, LongType, MapType,
                               ShortType, StringType)

from ..functions.features import lenient_double
from .ranks import approximate_quantiles, long_values, narrow, quantiles
from ..functions.names import qcol


def _q(name: str) -> Column:
    return qcol(name)


def _text_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) with every value as text; NaN counts as missing."""
    exprs = []
    for f in df.schema.fields:
        if f.name not in cols:
            continue
        c = _q(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        exprs.append(c.cast("string").alias(f.name))
    return df.select(*exprs).unpivot([], list(cols), "column", "value")


def _value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, cnt) including the null value; partial aggregation per task."""
    return _text_long(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def type_class(dtype) -> str:
    """Three classes used by the table overview: text, int, float (else: other)."""
    if isinstance(dtype, StringType):
        return "text"
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return "int"
    if isinstance(dtype, (FloatType, DoubleType)):
        return "float"
    return "other"


def table_shape(df: DataFrame) -> DataFrame:
    """Rows, columns, and column count per type class (one count job)."""
    classes = [type_class(f.dataType) for f in df.schema.fields]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_cols"),
        F.lit(classes.count("text")).alias("n_text_cols"),
        F.lit(classes.count("int")).alias("n_int_cols"),
        F.lit(classes.count("float")).alias("n_float_cols"))


def _missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, missing, n) in one narrow aggregate; NaN counts as missing."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    gone = [F.count_if(_q(c).isNull() | F.isnan(_q(c)) if isinstance(kinds[c], (DoubleType, FloatType))
                       else _q(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)]
    one = df.agg(*gone, F.count(F.lit(1)).alias("n"))
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(cols)])
    return one.select(F.explode(each).alias("e"), "n").select("e.*", "n")


def _present(df: DataFrame, column: str) -> Column:
    """A column's values as they are, but null for NaN, and text for maps (which cannot be grouped)."""
    kind = df.schema[column].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        return F.when(~F.isnan(_q(column)), _q(column))
    return _q(column).cast("string") if isinstance(kind, MapType) else _q(column)


def typed_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, value, cnt): rows of each value of column number ``i``, missing ones too, in one pass.

    ``value`` has a field per type, so values are grouped in their own types; a
    missing value is null in all fields.
    """
    values = {c: _present(df, c) for c in cols}
    kinds = {c: df.select(v).schema[0].dataType.simpleString() for c, v in values.items()}
    fields = {k: f"v{n}" for n, k in enumerate(dict.fromkeys(kinds.values()))}
    cells = [F.struct(F.lit(i).alias("i"), *[(values[c] if kinds[c] == k else F.lit(None).cast(k)).alias(f)
                                             for k, f in fields.items()]) for i, c in enumerate(cols)]
    return (df.select(F.explode(F.array(*cells)).alias("e")).select("e.*").groupBy("i", *fields.values())
            .agg(F.count("*").alias("cnt")).select("i", F.struct(*fields.values()).alias("value"), "cnt"))


def distinct_sketches(df: DataFrame, cols: Sequence[str], precision: int = 12) -> DataFrame:
    """(column, sketch): one small mergeable sketch of the distinct values per column.

    To be stored and united later, with those of other parts of the data too
    (:func:`distinct_estimates`).
    """
    hashed = df.select(*[F.when(_present(df, c).isNotNull(), F.xxhash64(_present(df, c))).alias(c) for c in cols])
    return (hashed.unpivot([], [_q(c) for c in cols], "column", "value").groupBy("column")
            .agg(F.hll_sketch_agg("value", precision).alias("sketch")))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(column, distinct), about, of all sketches of a column together."""
    return sketches.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Per column: Spark type, missing count, distinct non-null count, has_missing.

    Exact counts first make (column, value) distinct, which spreads a column
    over all tasks, and then count.  ``exact=False`` estimates them from
    sketches in one pass.
    """
    cols = list(cols or df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if exact:
        counts = typed_counts(df, cols)
        names = F.array(*[F.lit(c) for c in cols])
        empty = ~F.exists(F.array(*[F.col(f"value.{f}").isNotNull() for f in counts.schema["value"].dataType.names]), lambda x: x)
        found = counts.groupBy("i").agg(
            F.coalesce(F.sum(F.when(empty, F.col("cnt"))), F.lit(0)).alias("missing"),
            F.count_if(~empty).alias("distinct")).select(F.element_at(names, F.col("i") + 1).alias("column"), "missing", "distinct")
    else:
        found = _missing(df, cols).join(distinct_estimates(distinct_sketches(df, cols)), "column")
    types = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(kinds[c]))])
    return found.select("column", F.element_at(types, F.col("column")).alias("dtype"), "missing", "distinct",
                        (F.col("missing") > 0).alias("has_missing"))


def missing_ranking(df: DataFrame, cols: Sequence[str] | None = None,
                    note_above: float = 50.0) -> DataFrame:
    """Columns with missing values, most first, with percent of rows."""
    pct = F.col("missing") * 100.0 / F.col("n")
    return (_missing(df, list(cols or df.columns)).where(F.col("missing") > 0)
            .select("column", "missing", pct.alias("pct"), (pct > note_above).alias("over_half"))
            .orderBy(F.desc("missing"), "column"))


def numeric_describe(df: DataFrame, cols: Sequence[str], quantile_method: str = "exact") -> DataFrame:
    """count, mean, std (sample), min, p25, p50, p75, max per column.

    The columns are written once; moments are one unpivoted aggregation and
    quartiles come from :mod:`ranks` (exact, or its sketch with ``approx``).
    """
    cols = [c for c in cols if c in df.columns]
    table = narrow(df, cols)
    long = long_values(table, cols)
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    probs = [0.25, 0.5, 0.75]
    qs = (quantiles(long, ["column"], probs, table.count()) if quantile_method == "exact"
          else approximate_quantiles(long, ["column"], probs))
    quart = qs.groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                       for p, n in zip(probs, ("p25", "p50", "p75"))])
    return moments.join(quart, "column").select("column", "count", "mean", "std", "min",
                                               "p25", "p50", "p75", "max")


def _top_of(counts: DataFrame) -> DataFrame:
    """From (column, value, cnt): most frequent non-null value, ties -> smallest value.

    An all-null column keeps its row: count 0, unique 0, top and freq null.
    """
    present = F.col("value").isNotNull()
    order = F.struct((~present).alias("n"), (-F.col("cnt")).alias("c"), F.col("value").alias("v"))
    return counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(present, F.col("cnt"))), F.lit(0)).alias("count"),
        F.count("value").alias("unique"),
        F.min_by("value", order).alias("top"),
        F.max(F.when(present, F.col("cnt"))).alias("freq"))


def categorical_describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count (non-null), unique, top (ties -> smallest), freq per column."""
    cols = [c for c in cols if c in df.columns]
    return _top_of(_value_counts(df, cols))


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mode) with the smallest value on ties; all-null column -> no row."""
    cols = [c for c in cols if c in df.columns]
    return _top_of(_value_counts(df, cols)).select("column", F.col("top").alias("mode"))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, count) of non-null values, most frequent first."""
    cols = [c for c in cols if c in df.columns]
    return (_value_counts(df, cols).where(F.col("value").isNotNull())
            .select("column", "value", F.col("cnt").alias("count"))
            .orderBy("column", F.desc("count"), "value"))


def top_k(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k most frequent non-null values (ties by value); a top-k, so limit is the feature."""
    return (df.where(_q(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(k))


def group_rate(df: DataFrame, group_col: str, target_col: str,
               rate_name: str = "rate") -> DataFrame:
    """Mean of a 0/1 target per group (text target parsed leniently), null group left out."""
    return (df.where(_q(group_col).isNotNull())
            .groupBy(group_col).agg(F.avg(lenient_double(_q(target_col))).alias(rate_name))
            .orderBy(F.desc(rate_name), F.asc(group_col)))


def rank_picks(rates: DataFrame, group_col: str, rate_col: str) -> DataFrame:
    """first, second, third and last group of a rate table ordered high to low.

    ``rates`` is an aggregate (one row per group), so the un-partitioned
    window below runs over the group count, not over data rows.
    """
    desc = Window.orderBy(F.desc(rate_col), F.asc(group_col))
    asc = Window.orderBy(F.asc(rate_col), F.desc(group_col))
    ranked = rates.select(group_col, rate_col, F.row_number().over(desc).alias("_d"),
                          F.row_number().over(asc).alias("_a"))
    pick = (F.when(F.col("_d") == 1, "first").when(F.col("_d") == 2, "second")
            .when(F.col("_d") == 3, "third"))
    first3 = ranked.where(F.col("_d") <= 3).select(pick.alias("pick"), group_col, rate_col)
    last = ranked.where(F.col("_a") == 1).select(F.lit("last").alias("pick"), group_col, rate_col)
    return first3.unionByName(last)


def crosstab_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Two-way counts (a, b, count) over rows where both are present."""
    return (df.where(_q(a).isNotNull() & _q(b).isNotNull())
            .groupBy(a, b).agg(F.count(F.lit(1)).alias("count")))


def conditional_mean(df: DataFrame, filter_col: str, equals, target_col: str,
                     name: str = "mean") -> DataFrame:
    """Mean of target over rows where filter_col == equals (nulls skipped)."""
    return df.agg(F.avg(F.when(_q(filter_col) == F.lit(equals),
                               lenient_double(_q(target_col)))).alias(name))


class _Moments:
    """Moments of every pair of columns over the rows that have both: counts, means, squares, products."""

    def __init__(self, m: int):
        self.n = np.zeros((m, m))
        self.mean, self.square, self.product = np.zeros((m, m)), np.zeros((m, m)), np.zeros((m, m))

    @classmethod
    def of(cls, x: np.ndarray) -> "_Moments":
        """Of a block of rows (NaN: missing), as products of matrices around the first value of each column."""
        out = cls(x.shape[1])
        there = ~np.isnan(x)
        first = np.where(there.any(axis=0), x[there.argmax(axis=0), np.arange(x.shape[1])], 0.0)
        w, c = there.astype(float), np.where(there, x - first, 0.0)
        out.n = w.T @ w
        total, n = c.T @ w, np.maximum(out.n, 1)
        out.mean = first[:, None] + total / n
        out.square = (c * c).T @ w - total * total / n
        out.product = c.T @ c - total * total.T / n
        return out

    def add(self, other: "_Moments") -> None:
        n = np.maximum(self.n + other.n, 1)
        apart = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        weight = self.n * other.n / n
        self.square += other.square + apart * apart * weight
        self.product += other.product + apart * apart.T * weight
        self.mean = np.where(self.n > 0, self.mean + apart * other.n / n, other.mean)
        self.n += other.n

    def row(self) -> pa.RecordBatch:
        parts = [self.n, self.mean, self.square, self.product]
        return pa.RecordBatch.from_arrays([pa.array([p.ravel().tolist()], pa.list_(pa.float64())) for p in parts],
                                          names=["n", "mean", "square", "product"])

    @classmethod
    def from_row(cls, row: dict, m: int) -> "_Moments":
        out = cls(m)
        out.n, out.mean, out.square, out.product = (np.array(row[k]).reshape(m, m) for k in ("n", "mean", "square", "product"))
        return out


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair, pairwise-complete rows, numbers parsed leniently.

    Every task multiplies its blocks of rows into matrices of counts, squares
    and products of all pairs, merges them, and hands on one row; these are
    merged by one task that holds one matrix of each kind.  A column that is
    constant over a pair's rows has a null r with it.
    Returns (row_col, col_col, row_idx, col_idx, r).
    """
    cols = [c for c in cols if c in df.columns]
    m = len(cols)
    nums = df.select(*[lenient_double(_q(c)).alias(f"c{i}") for i, c in enumerate(cols)])

    def partial(batches):
        total = _Moments(m)
        for batch in batches:
            if batch.num_rows:
                total.add(_Moments.of(np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])))
        if total.n.any():
            yield total.row()

    def merged(batches):
        total = _Moments(m)
        for batch in batches:
            for row in batch.to_pylist():
                total.add(_Moments.from_row(row, m))
        if total.n.any():
            with np.errstate(divide="ignore", invalid="ignore"):
                r = total.product / np.sqrt(total.square * total.square.T)
            i, j = np.indices((m, m))
            void = (total.square <= 0) | (total.square.T <= 0)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                              pa.array(r.ravel(), pa.float64(), mask=void.ravel())], names=["i", "j", "r"])

    kinds = ", ".join(f"{k} array<double>" for k in ("n", "mean", "square", "product"))
    cells = nums.mapInArrow(partial, kinds).repartition(1).mapInArrow(merged, "i int, j int, r double")
    names = F.array(*[F.lit(c) for c in cols])
    return cells.select(F.element_at(names, F.col("i") + 1).alias("row_col"), F.element_at(names, F.col("j") + 1).alias("col_col"),
                        F.col("i").alias("row_idx"), F.col("j").alias("col_idx"), "r")


def lower_triangle(corr: DataFrame) -> DataFrame:
    """Cells strictly below the diagonal (the part a masked heat map shows)."""
    return corr.where(F.col("row_idx") > F.col("col_idx"))
