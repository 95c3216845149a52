"""Continuous scoring of arriving booking records with Structured Streaming.

Records land as JSON-lines files in a folder; each micro-batch is scored
by the saved pipeline (stateless, no shuffle) and appended to a parquet
sink.  The checkpoint in the shared folder makes the file sink
exactly-once across restarts and lost executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.scoring import score_frame
from ..session import scratch_path


def start_scoring_stream(spark: SparkSession, pipeline: PipelineModel, source_dir: str,
                         schema: StructType, sink_dir: str, checkpoint_dir: str | None = None,
                         keep: Sequence[str] = ("booking_id",), processed: bool = False,
                         available_now: bool = True, files_per_batch: int = 100) -> StreamingQuery:
    """Start the stream; ``available_now`` drains what is there and stops (batch-like runs)."""
    records = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
               .json(source_dir))
    scored = score_frame(pipeline, records, processed=processed, keep=keep)
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir or scratch_path(spark, "scoring-stream")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()
