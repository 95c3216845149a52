"""Lineage cuts: tables in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again.

    A lost executor takes none of it along, and later jobs start from it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
