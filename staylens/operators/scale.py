"""Numeric scaling: fitted mean / sample std / min / max per column.

Min-max: (x - min) / (max - min), a zero range counts as 1, no clipping.
Standard: (x - mean) / std, a zero std counts as 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from .ranks import long_values
from ..functions.names import qcol


def scaler_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mean, std, min, max, n) of the values there are, in one scan; each column is its own group."""
    return long_values(df, cols).groupBy("column").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.count("*").alias("n"))


def filled_stats(stats: DataFrame, fill: dict[str, float], rows: int) -> dict[str, dict[str, float]]:
    """Statistics of the columns with every missing one of ``rows`` values filled, without another scan."""
    found = {r["column"]: r for r in stats.collect()}
    out = {}
    for c, v in fill.items():
        r = found.get(c)
        n, missing = (r["n"], rows - r["n"]) if r else (0, rows)
        own = r["mean"] if n else v
        mean = own + (v - own) * missing / rows if rows else v
        spread = (r["std"] ** 2 * (n - 1) if n > 1 else 0.0) + (n * (own - mean) ** 2 + missing * (v - mean) ** 2 if missing else 0.0)
        values = ([r["min"], r["max"]] if n else []) + ([v] if missing else [])
        out[c] = {"mean": mean, "std": (spread / (rows - 1)) ** 0.5 if rows > 1 else float("nan"),
                  "min": min(values, default=v), "max": max(values, default=v)}
    return out


def indicator_stats(n: int, count: int) -> dict[str, float]:
    """Stats of a 0/1 column with ``count`` ones among ``n`` rows (no extra scan)."""
    mean = count / n
    std = (count * (n - count) / (n * (n - 1))) ** 0.5 if n > 1 else float("nan")
    return {"mean": mean, "std": std, "min": 0.0 if count < n else 1.0,
            "max": 1.0 if count > 0 else 0.0}


def scaled(col: Column, stats: dict[str, float], method: str = "minmax") -> Column:
    if method == "standard":
        std = stats["std"]
        std = 1.0 if std == 0 else std
        return (col - F.lit(stats["mean"])) / F.lit(std)
    rng = stats["max"] - stats["min"]
    rng = 1.0 if rng == 0 else rng
    return (col - F.lit(stats["min"])) / F.lit(rng)


def apply_scaler(df: DataFrame, stats: dict[str, dict[str, float]], method: str = "minmax") -> DataFrame:
    return df.select(*[(scaled(qcol(c).cast("double"), stats[c], method) if c in stats
                        else qcol(c)).alias(c) for c in df.columns])
