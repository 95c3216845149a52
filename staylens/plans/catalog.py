"""Registry of named queries: a Spark callable and, where SQL can state it, a DuckDB oracle.

Each callable takes (spark, sf_dir) and returns a lazy DataFrame over the
whole driver tables.  Modules below add their entries on import.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c: Column | str) -> Column:
    """Round to 6 places (both sides of the oracle check do the same)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def r6_double(c: Column) -> Column:
    """:func:`r6` of a double column, which goes through a decimal only near a tie and for very large values.

    Elsewhere the nearest millionth is a whole number below 2^53 over 10^6, which is the same double.
    """
    whole = F.rint(c * 1e6)
    plain = (F.abs(c * 1e6) < 1e11) & (F.abs(c * 1e6 - whole) < 0.499)
    return F.when(plain, whole / 1e6 + 0.0).otherwise(r6(c))


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for mod in MODULES:
        importlib.import_module(f"{__package__}.{mod}")


MODULES = ("q_profile", "q_rows", "q_fit", "q_split", "q_distribution", "q_evaluate", "q_train",
           "q_files")
