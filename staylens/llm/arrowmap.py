"""Columns computed from Arrow batches inside Spark tasks."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of an Arrow batch: one batch of long texts must fit in a Python worker.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def small_batches(df: DataFrame) -> None:
    for key, value in BATCH.items():
        df.sparkSession.conf.set(key, value)


class Shared:
    """A broadcast of an object of this package's own classes."""

    def __init__(self, spark: SparkSession, value):
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self.packed.value)


def fresh(base: str, taken: Sequence[str]) -> str:
    """``base``, or ``base`` with underscores before it, that is no name in ``taken``."""
    lower = {t.lower() for t in taken}
    while base.lower() in lower:
        base = "_" + base
    return base


def add_struct(df: DataFrame, inputs: Sequence[str], keep: Sequence[str], name: str, kind: StructType,
               compute: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, pa.StructArray]]],
               ) -> DataFrame:
    """``keep`` columns and the struct column ``name`` that ``compute`` makes.

    ``compute`` gets the batches whose first columns are ``inputs`` and yields,
    for every batch in order, the batch (or a slice of it) and the struct of
    each row; it may hold several batches back to work on them together.
    Columns travel under positions, so their names cannot clash.
    """
    small_batches(df)
    n = len(inputs)
    narrow = df.select(*[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(inputs)],
                       *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    schema = StructType([*narrow.schema.fields[n:], *StructType().add("made", kind).fields])

    def run(batches):
        for batch, made in compute(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[n:], made],
                                             names=[*batch.schema.names[n:], "made"])

    return narrow.mapInArrow(run, schema).toDF(*keep, name)


def whole_groups(batches: Iterator[pa.RecordBatch], key: list[str], least: int = 1) -> Iterator[pa.Table]:
    """Whole groups of equal ``key`` from sorted batches, ``least`` rows or more at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in key:
            c = batch.column(k)
            change[1:] |= ~np.asarray(c[1:].to_numpy(zero_copy_only=False) == c[:-1].to_numpy(zero_copy_only=False))
        cut = np.flatnonzero(change)
        if sum(b.num_rows for b in held) >= least and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in key):
            yield pa.Table.from_batches(held)
            held = []
        if len(cut):
            last = int(cut[-1])
            if last + sum(b.num_rows for b in held) >= least:
                yield pa.Table.from_batches([*held, batch.slice(0, last)])
                held = [batch.slice(last)]
            else:
                held.append(batch)
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
