"""File sources and sinks: raw CSV, processed tables, result tables, evaluation records, models."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, LongType, MapType, StringType,
                               StructField, StructType)
from pyspark.sql.utils import AnalysisException

from ..functions.features import as_type, text_or_null
from ..functions.names import clean_name
from ..functions.names import qcol

# Raw booking columns and their types; agent and company stay text on purpose.
RAW_TYPES = {
    "hotel": "string", "is_canceled": "int", "lead_time": "int", "arrival_date_year": "int",
    "arrival_date_month": "string", "arrival_date_week_number": "int",
    "arrival_date_day_of_month": "int", "stays_in_weekend_nights": "int",
    "stays_in_week_nights": "int", "adults": "int", "children": "double", "babies": "int",
    "meal": "string", "country": "string", "market_segment": "string",
    "distribution_channel": "string", "is_repeated_guest": "int",
    "previous_cancellations": "int", "previous_bookings_not_canceled": "int",
    "reserved_room_type": "string", "assigned_room_type": "string", "booking_changes": "int",
    "deposit_type": "string", "agent": "string", "company": "string",
    "days_in_waiting_list": "int", "customer_type": "string", "adr": "double",
    "required_car_parking_spaces": "int", "total_of_special_requests": "int",
    "reservation_status": "string", "reservation_status_date": "date",
}


def read_raw_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None,
                 line_breaks: bool = False) -> DataFrame:
    """Header CSV read as text, NA tokens to null, then typed by name (unknown names stay text).

    Quotes inside a quoted field are doubled and a backslash is an ordinary
    character.  With ``line_breaks`` fields may hold them, and a file is read by
    one task; without, large files are split.  A whole number may be written
    with a fraction of zero.  A field that does not parse becomes null;
    :func:`unparsed` counts those.
    """
    raw = _raw_text(spark, path, line_breaks)
    return raw.select(*[_typed(c, _type_of(c, types)).alias(c) for c in raw.columns])


def unparsed(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """One row: for each typed column, how many fields hold text that is not of its type."""
    raw = _raw_text(spark, path)
    lost = [F.count_if(_text(c).isNotNull() & _typed(c, t).isNull()).alias(c)
            for c in raw.columns if (t := _type_of(c, types)) != "string"]
    return raw.agg(*lost) if lost else spark.createDataFrame([], StructType())


def _raw_text(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    try:
        raw = (spark.read.option("header", True).option("inferSchema", False).option("quote", '"')
               .option("escape", '"').option("multiLine", line_breaks).csv(path))
        raw.schema  # noqa: B018  (resolves the path now)
    except AnalysisException as err:
        raise FileNotFoundError(f"no CSV can be read at {path}") from err
    return raw


def _type_of(column: str, types: dict[str, str] | None) -> str:
    types = RAW_TYPES if types is None else types
    return types.get(column, types.get(clean_name(column), "string"))


def _text(column: str) -> Column:
    return text_or_null(qcol(column))


def _typed(column: str, kind: str) -> Column:
    return as_type(qcol(column), StringType(), kind)


def read_processed(spark: SparkSession, path: str, target: str, fmt: str = "parquet"):
    """(frame, feature names): every column but the target is a feature."""
    df = (spark.read.parquet(path) if fmt == "parquet"
          else spark.read.option("header", True).option("inferSchema", True).csv(path))
    if target not in df.columns:
        raise KeyError(f"the table has no column {target!r} to learn")
    return df, [c for c in df.columns if c != target]


def write_processed(df: DataFrame, path: str, target: str, fmt: str = "parquet") -> None:
    """Features then the target as last column; the label stays in its row."""
    if target not in df.columns:
        raise KeyError(f"the frame has no column {target!r} to write last")
    out = df.select(*[qcol(c) for c in df.columns if c != target], F.col(target))
    writer = out.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("header", True).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    """Result table (importances, comparison) as header CSV."""
    df.write.mode("overwrite").option("header", True).csv(path)


REPORT_ROW = StructType([StructField("precision", DoubleType()), StructField("recall", DoubleType()),
                         StructField("f1_score", DoubleType()), StructField("support", LongType())])
EVAL_SCHEMA = StructType([
    StructField("model_name", StringType()),
    StructField("best_cv_score", DoubleType()),
    StructField("accuracy", DoubleType()),
    StructField("report", MapType(StringType(), REPORT_ROW)),
    StructField("confusion_matrix", ArrayType(ArrayType(LongType()))),
    StructField("auc", DoubleType()),
    StructField("roc_path", StringType()),
])


def write_evaluation(spark: SparkSession, record: dict, path: str) -> None:
    """One evaluation record as a JSON file (ROC points live in their own table at roc_path)."""
    row = {k: record.get(k) for k in EVAL_SCHEMA.fieldNames()}
    spark.createDataFrame([row], EVAL_SCHEMA).coalesce(1).write.mode("overwrite").json(path)


def read_evaluations(spark: SparkSession, pattern: str) -> DataFrame:
    """All evaluation records under a glob; none found -> empty frame."""
    try:
        return spark.read.schema(EVAL_SCHEMA).json(pattern)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EVAL_SCHEMA)


def flatten_evaluation(df: DataFrame) -> DataFrame:
    """One line per key: scalars as text, lists as their item count, maps as key/value lines."""
    scalars = [F.struct(F.lit(k).alias("key"), F.lit(None).cast("string").alias("sub_key"),
                        F.col(k).cast("string").alias("value"))
               for k in ("best_cv_score", "accuracy", "auc", "roc_path")]
    lists = [F.struct(F.lit("confusion_matrix").alias("key"), F.lit(None).cast("string").alias("sub_key"),
                      F.format_string("List with %d items", F.size("confusion_matrix")).alias("value"))]
    flat = df.select("model_name", F.explode(F.array(*scalars, *lists)).alias("_l")).select(
        "model_name", "_l.*")
    maps = df.select("model_name", F.explode("report").alias("sub_key", "_r")).select(
        "model_name", F.lit("report").alias("key"), "sub_key", F.to_json("_r").alias("value"))
    return flat.unionByName(maps)


def records_frame(spark: SparkSession, records: Sequence[dict], schema: StructType | str | None = None) -> DataFrame:
    """A batch of request records as a frame; an empty batch is an error."""
    if not records:
        raise ValueError("no records given")
    return spark.createDataFrame(list(records), schema) if schema else spark.createDataFrame(list(records))


def save_model(model, path: str) -> str:
    """Persist a fitted model or pipeline; an untrained model is an error."""
    if model is None:
        raise ValueError("there is no fitted model to save")
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str):
    """Load a saved PipelineModel; a missing artifact is an error."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(_there(path, "pipeline"))


def load_preprocessor(path: str):
    """Load a saved preprocessor with its dictionary; a missing artifact is an error."""
    from ..operators.preprocess import BookingPreprocessorModel
    return BookingPreprocessorModel.load(_there(path, "preprocessor"))


def _there(path: str, what: str) -> str:
    if "://" not in path and not os.path.exists(path):
        raise RuntimeError(f"no saved {what} at {path}")
    return path
