"""Deterministic stratified train/test split and cross-validation folds, by cut points.

Every row gets a hash of its key columns (all columns by default).  Per label
the hashes at a few ranks are found (:func:`ranks.values_at` on a table of
label and hash alone), and a row's part follows from comparing its hash with
them, so rows stay where they are:

* the ``round(test_size * n_label)`` lowest hashes are test rows;
* the train rows are cut into ``k`` folds of consecutive hashes.

Same proportions per label as a stratified shuffle split (within one row),
and the same rows on every run, partitioning and cluster size.  Rows that share
the hash of a cut are divided by count: equal ones are counted, their copies
dealt to the parts, and different rows with one key go by all their columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import running_sums, same_keys, values_at
from ..functions.names import qcol
from ..session import stored

DEFAULT_SEED = 42
#: Copies of one row that are written in one go.
COPIES = 10_000


def row_hash(cols: Sequence[str], method: str = "xxhash64", seed: int = DEFAULT_SEED) -> Column:
    """The first 53 bits of xxhash64 (fast, default) or 52 of md5 (portable to other engines); doubles hold both exactly."""
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[qcol(c) for c in cols]), 11)
    if method == "md5":
        text = F.concat_ws("|", F.lit(str(seed)), *[qcol(c).cast("string") for c in cols])
        return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    raise ValueError(f"unknown hash method {method!r}")


def _first_ranks(n: Column, test_size: float, folds: int) -> Column:
    """The rank that each part after the test rows begins at, where it has rows."""
    n_test = F.floor(F.lit(float(test_size)) * n + F.lit(0.5)).cast("long")
    n_train = n - n_test
    starts = [n_test + F.ceil(n_train * f / folds).cast("long") if f else n_test for f in range(max(folds, 1))]
    aims = F.array(*[F.struct(F.lit(i).alias("id"), s.alias("first"), s.alias("last")) for i, s in enumerate(starts)])
    return F.filter(aims, lambda a: a["first"] < n)


def _by_count(rows: DataFrame, columns: Sequence[str], label_col: str) -> DataFrame:
    """Rows that share the hash of a cut, dealt to the parts by their rank: (columns, _part)."""
    value = F.struct(*[qcol(c).alias(f"c{i}") for i, c in enumerate(columns)])
    counted = rows.groupBy(value.alias("_row"), F.col("_h"), F.col("_cuts"), qcol(label_col).alias("_label")).agg(
        F.count("*").alias("_c"))
    ranked = running_sums(counted, ["_label", "_h"], "_row", ["_c"])
    cut = F.filter("_cuts", lambda x: x["value"] == F.col("_h"))[0]
    start = cut["below"] + F.col("_c_before")
    ends = F.concat(F.transform("_cuts", lambda x: x["first"]), F.array(F.lit((1 << 63) - 1)))
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("_cuts", lambda x: x["first"]))
    parts = F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda p, i: F.struct(
        i.alias("_part"), (F.least(p["b"], F.col("_start") + F.col("_c")) - F.greatest(p["a"], F.col("_start"))).alias("m")))
    dealt = (ranked.withColumn("_start", start).select("_row", F.explode(parts).alias("p")).where("p.m > 0")
             .select("_row", "p._part", "p.m", F.explode(F.sequence(F.lit(0), F.floor((F.col("p.m") - 1) / COPIES))).alias("k")))
    # A row with very many copies is written by many tasks.
    some = F.least(F.col("m") - F.col("k") * COPIES, F.lit(COPIES)).cast("int")
    each = dealt.repartition("k", "_part").select("_row", "_part", F.explode(F.array_repeat(F.lit(0), some)))
    return each.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(columns)], "_part")


def assign_split(df: DataFrame, label_col: str, test_size: float = 0.3, folds: int = 0,
                 key_cols: Sequence[str] | None = None, hash_method: str = "xxhash64",
                 seed: int = DEFAULT_SEED, part_col: str = "part",
                 fold_col: str = "fold") -> DataFrame:
    """Adds ``part`` ('train' / 'test') and, with ``folds`` > 1, ``fold`` (train rows; test: null)."""
    columns = list(df.columns)
    hashed = df.withColumn("_h", row_hash(list(key_cols or [c for c in columns if c != label_col]), hash_method, seed))
    table = stored(hashed.select(qcol(label_col).alias("_label"), F.col("_h").alias("value")), "hashes")
    folds = folds if folds and folds > 1 else 0
    cuts = values_at(table, ["_label"], lambda n: _first_ranks(n, test_size, folds), table.count())
    # One row per label, of as many cuts as there are parts.
    cuts = stored(cuts.groupBy("_label").agg(F.sort_array(F.collect_list(F.struct(
        "id", F.col("v_first").alias("value"), "first", "below", "equal"))).alias("_cuts")), "cuts")
    cuts = cuts.withColumnRenamed("_label", label_col)
    # A label whose rows are all test rows has no cuts.
    met = same_keys(hashed, cuts, [label_col], "left").withColumn(
        "_cuts", F.coalesce("_cuts", F.array().cast(cuts.schema["_cuts"].dataType)))
    after = F.size(F.filter("_cuts", lambda x: x["value"] <= F.col("_h")))
    shared = F.exists("_cuts", lambda x: (x["value"] == F.col("_h")) & (x["equal"] > 1))
    if cuts.where(F.exists("_cuts", lambda x: x["equal"] > 1)).isEmpty():
        out = met.select(*[qcol(c) for c in columns], after.alias("_part"))
    else:
        alone = met.where(~shared).select(*[qcol(c) for c in columns], after.alias("_part"))
        out = alone.unionByName(_by_count(met.where(shared), columns, label_col))
    part = F.when(F.col("_part") == 0, "test").otherwise("train")
    fold = F.when(F.col("_part") > 0, F.col("_part") - 1).cast("int")
    return out.select(*[qcol(c) for c in columns], part.alias(part_col), *([fold.alias(fold_col)] if folds else []))
