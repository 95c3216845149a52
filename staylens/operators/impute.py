"""Missing-value imputation: fit per-column fill values, then fill.

Numeric: median (default, exact), mean, or 0 for any other strategy; a
column without values gets 0.  Categorical: most frequent value (ties ->
smallest) or "Unknown".  Fitted values are one per column, so they are
collected to the driver and become literals of one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import categorical_columns, numeric_columns
from .profile import modes
from .ranks import long_values, narrow, quantiles
from ..functions.names import qcol

UNKNOWN = "Unknown"


def _fills(table: DataFrame, cols: Sequence[str], strategy: str, rows: int) -> DataFrame:
    """(column, _v) of the columns that have values, from a :func:`ranks.narrow` table."""
    if strategy == "median":
        return quantiles(long_values(table, cols), ["column"], [0.5], rows).select("column", F.col("value").alias("_v"))
    if strategy == "mean":
        return long_values(table, cols).groupBy("column").agg(F.avg("value").alias("_v"))
    return table.sparkSession.createDataFrame([], "column string, _v double")


def fills_of(table: DataFrame, cols: Sequence[str], strategy: str, rows: int) -> dict[str, float]:
    """Fill value of each numeric column of a narrow table, collected (one per column)."""
    found = {r["column"]: float(r["_v"]) for r in _fills(table, cols, strategy, rows).collect()}
    return {c: found.get(c, 0.0) for c in cols}


def numeric_fill_values(df: DataFrame, cols: Sequence[str], strategy: str = "median") -> DataFrame:
    """(column, value); every listed column has a row (0.0 when it has no value)."""
    spark = df.sparkSession
    names = spark.createDataFrame([(c, i) for i, c in enumerate(cols)], "column string, pos int")
    table = narrow(df, cols)
    stat = _fills(table, cols, strategy, table.count())
    return (names.join(stat, "column", "left")
            .select("column", F.coalesce("_v", F.lit(0.0)).alias("value"), "pos"))


def categorical_fill_values(df: DataFrame, cols: Sequence[str], strategy: str = "mode") -> DataFrame:
    """(column, value) lazily; all-null column or non-mode strategy -> "Unknown"."""
    spark = df.sparkSession
    names = spark.createDataFrame([(c, i) for i, c in enumerate(cols)], "column string, pos int")
    if strategy == "mode" and cols:
        stat = modes(df, cols).select("column", F.col("mode").alias("_v"))
    else:
        stat = names.select("column", F.lit(None).cast("string").alias("_v"))
    return (names.join(stat, "column", "left")
            .select("column", F.coalesce("_v", F.lit(UNKNOWN)).alias("value"), "pos"))


def fit_imputer(df: DataFrame, num_strategy: str = "median", cat_strategy: str = "mode",
                exclude: Sequence[str] = ()) -> dict[str, object]:
    """Fill value per column of ``df`` (numeric and categorical), collected (one per column)."""
    nums = numeric_columns(df, exclude)
    cats = categorical_columns(df, exclude)
    values: dict[str, object] = {}
    if nums:
        for r in numeric_fill_values(df, nums, num_strategy).collect():
            values[r["column"]] = float(r["value"])
    if cats:
        for r in categorical_fill_values(df, cats, cat_strategy).collect():
            values[r["column"]] = r["value"]
    return values


def apply_imputer(df: DataFrame, values: dict[str, object], fill_rest: bool = True) -> DataFrame:
    """Fill fitted columns by their value; then every remaining null becomes 0 ('0' for text)."""
    exprs = []
    for f in df.schema.fields:
        c = qcol(f.name)
        if f.name in values and isinstance(values[f.name], float):
            # A numeric column with gaps is fractional once filled (e.g. median 2.5).
            c = F.coalesce(F.when(~F.isnan(c.cast("double")), c.cast("double")),
                           F.lit(values[f.name]))
        elif f.name in values:
            c = F.coalesce(c.cast("string"), F.lit(values[f.name]))
        elif fill_rest:
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        exprs.append(c.alias(f.name))
    return df.select(*exprs)
