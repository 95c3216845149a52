"""One-hot encoding by a category dictionary that is a table.

Fitting counts the categories of all text columns in one pass and numbers them
per column in sorted order; the dictionary (pos, column, category, n, slot) is
a table of the model, of any length.  Transforming joins each column with its
part of the dictionary, so a row gets the numbers of its categories; indicator
columns and the sparse feature vector both follow from the numbers.

An unseen category or a null gives no slot (all indicators zero); a text column
missing at transform time counts as "Unknown".
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .impute import UNKNOWN
from .ranks import running_sums
from ..functions.names import qcol
from ..session import stored

#: A column's part of the dictionary is broadcast up to this many bytes, as measured when it was fitted.
BROADCAST_BYTES = 16 << 20
#: Beyond that, categories with this share of the rows or more are broadcast: at most its inverse, whatever the data.
FREQUENT = 1 / 1000
#: Groups that rows of frequent categories are spread over in the join with the others.
SPREAD = 4096


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, cnt) of non-null values; partial aggregation, one scan for all columns."""
    return _all_counts(df, cols).where(F.col("value").isNotNull())


def _all_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    long = (df.select(*[qcol(c).cast("string").alias(c) for c in cols])
            .unpivot([], [qcol(c) for c in cols], "column", "value"))
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def onehot_name(col: str, category: str) -> str:
    return f"{col}_{category}"


@dataclass
class Dictionary:
    """The fitted categories: a table, and what is known of each column (one value per column)."""

    table: DataFrame            # pos (of the column in ``columns``), column, category, n, slot
    columns: list[str]
    fill: dict[str, str]        # what a missing value becomes
    size: dict[str, int]        # number of categories
    bytes: dict[str, int]       # about the memory that a column's part takes


def fit_dictionary(df: DataFrame, cols: Sequence[str], strategy: str = "mode") -> Dictionary:
    """Fill values and numbered categories of the filled columns; nothing but a row per column reaches the driver."""
    cols = list(cols)
    spark = df.sparkSession
    names = spark.createDataFrame(list(enumerate(cols)), "pos int, column string")
    counts = stored(_all_counts(df, cols), "category-counts")
    if strategy == "mode":
        order = F.struct(F.col("value").isNull(), -F.col("cnt"), F.col("value"))
        found = counts.groupBy("column").agg(F.min_by("value", order).alias("fill"))
        fill = {r["column"]: UNKNOWN if r["fill"] is None else r["fill"] for r in found.collect()}
    else:
        fill = {}
    fill = {c: fill.get(c, UNKNOWN) for c in cols}
    fills = spark.createDataFrame(list(fill.items()), "column string, fill string")
    filled = (counts.join(F.broadcast(fills), "column")
              .groupBy("column", F.coalesce("value", "fill").alias("category")).agg(F.sum("cnt").alias("n")))
    ordered = running_sums(filled.join(F.broadcast(names), "column").withColumn("one", F.lit(1).cast("long")),
                           ["pos"], "category", ["one"])
    table = stored(ordered.select("pos", "column", "category", "n", F.col("one_before").cast("int").alias("slot")),
                   "dictionary")
    sizes = {r["column"]: r for r in table.groupBy("column").agg(
        F.count("*").alias("k"), F.sum(F.octet_length("category") + 64).alias("b")).collect()}
    return Dictionary(table, cols, fill, {c: int(sizes[c]["k"]) if c in sizes else 0 for c in cols},
                      {c: int(sizes[c]["b"]) if c in sizes else 0 for c in cols})


def with_slots(df: DataFrame, dictionary: Dictionary, rows: int) -> DataFrame:
    """Adds ``_slot<i>`` and ``_n<i>``: the number and the training count of each column's category (null: unseen).

    A part that was measured to be small is broadcast.  Of a large one the
    frequent categories are (there are at most ``1 / FREQUENT`` of them among
    ``rows``), so that the join with the rest has no hot key.
    """
    columns = list(df.columns)
    out = df
    for i, c in enumerate(dictionary.columns):
        fill = F.lit(dictionary.fill[c])
        value = F.coalesce(qcol(c).cast("string"), fill) if c in columns else F.lit(UNKNOWN)
        part = dictionary.table.where(F.col("pos") == i).select(
            F.col("category").alias("_category"), F.col("slot").alias(f"_slot{i}"), F.col("n").alias(f"_n{i}"))
        if dictionary.bytes[c] <= BROADCAST_BYTES:
            out = out.join(F.broadcast(part), value == F.col("_category"), "left").drop("_category")
            continue
        often = F.col(f"_n{i}") >= rows * FREQUENT
        hot = part.where(often).toDF("_category", "_hot_slot", "_hot_n")
        met = out.join(F.broadcast(hot), value == F.col("_category"), "left").drop("_category")
        # Rows that are done are spread over keys which no category has.
        spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*[qcol(x) for x in columns]), F.lit(SPREAD)).cast("string"))
        met = met.withColumn("_key", F.when(F.col("_hot_slot").isNull(), value).otherwise(spread))
        met = met.join(part.where(~often), F.col("_key") == F.col("_category"), "left")
        out = met.select(*[qcol(x) for x in out.columns], F.coalesce("_hot_slot", f"_slot{i}").alias(f"_slot{i}"),
                         F.coalesce("_hot_n", f"_n{i}").alias(f"_n{i}"))
    return out


def indicators(dictionary: Dictionary, categories: dict[str, Sequence[str]]) -> dict[str, Column]:
    """Indicator columns of a :func:`with_slots` frame by their names, for the columns' listed categories."""
    return {onehot_name(c, category): F.when(F.col(f"_slot{i}") == slot, F.lit(1.0)).otherwise(F.lit(0.0))
            for i, c in enumerate(dictionary.columns) for slot, category in enumerate(categories[c])}
