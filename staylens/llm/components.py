"""Connected components by minimum labels, for graphs of any size."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    # Shuffle files of what has been written are of no more use; Spark deletes them
    # when it finds that nothing refers to them.
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.3)     # deleting goes on beside the next job
    return spark.read.parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its least node.

    Each round takes the least label among neighbours and then the label of that
    label, so labels travel twice as far each round.  Labels are aggregated
    before they are shuffled, so a node with very many edges is no hot group.
    """
    pairs = edges.where("a != b")
    both = written(pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("l"))
                     .select("node", F.least("node", "l").alias("label")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near")))
        step = (labels.join(near, labels.node == near.a)
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid")))
        far = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        labels = written(step.join(far, "mid").select("node", "old", F.least("mid", "far").alias("label")), "labels")
        if labels.where("old != label").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
