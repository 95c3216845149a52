"""End-to-end jobs: preprocess, profile, train / select, score.

Each job reads files, runs Spark work over all rows and writes tables; only
fitted state and per-model summaries (bounded by columns, categories and
models) reach the driver.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import as_text, profile_features
from ..functions.names import clean_columns, clean_name
from ..operators import distribution as D
from ..operators import profile as P
from ..operators.columns import dedupe, feature_names
from ..operators.preprocess import BookingPreprocessor, FeatureVector
from ..operators.ranks import exact_quantiles
from ..operators.split import assign_split
from ..operators.train import SearchConfig
from ..sources.files import load_pipeline, load_preprocessor, read_processed, read_raw_csv, save_model, write_processed
from .frames import BOX_COLS, COUNT_COLS, DESCRIBE_COLS, HEAT_COLS, HIST_COLS
from .scoring import score_records, scoring_pipeline
from .training import TrainingData, auto_select, run_model, summary_frame, write_comparison


def read_input(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """CSV (raw reader with NA tokens and typed columns), JSON lines or parquet; told by the suffix unless given."""
    fmt = fmt or next((f for f in ("csv", "json") if path.lower().rstrip("/").endswith("." + f)), "parquet")
    if fmt == "csv":
        return read_raw_csv(spark, path)
    return spark.read.json(path) if fmt == "json" else spark.read.parquet(path)


def preprocess_job(spark: SparkSession, raw: DataFrame, out_dir: str, target: str = "is_canceled",
                   test_size: float = 0.3, seed: int = 42, scale_method: str = "minmax",
                   keep: Sequence[str] = (), fmt: str = "parquet", drop: Sequence[str] = ()) -> dict[str, str]:
    """Clean names -> dedupe (label included) -> stratified split -> fit on train only ->
    transform both -> processed tables (label last) and the saved preprocessor."""
    rows = dedupe(clean_columns(raw))
    target = clean_name(target)
    feature_names(rows, target)  # a missing target is an error before any job runs
    split_path = os.path.join(out_dir, "_split")
    assign_split(rows, target, test_size, seed=seed).write.mode("overwrite").parquet(split_path)
    tagged = spark.read.parquet(split_path)
    train = tagged.where(F.col("part") == "train").drop("part")
    test = tagged.where(F.col("part") == "test").drop("part")
    prep = BookingPreprocessor(labelCol=target, passthroughCols=list(keep), dropColumns=list(drop),
                               scaleMethod=scale_method).fit(train)
    if fmt != "parquet" and not prep.wide:
        raise ValueError(f"{prep.fitted['n_features']} features are written as vectors, which {fmt} files cannot hold")
    paths = {"train": os.path.join(out_dir, "train_processed"),
             "test": os.path.join(out_dir, "test_processed"),
             "preprocessor": os.path.join(out_dir, "preprocessor")}
    for part, frame in (("train", train), ("test", test)):
        out = prep.transform(frame)
        write_processed(out.drop(*[k for k in keep if k in out.columns]), paths[part], target, fmt)
    save_model(prep, paths["preprocessor"])
    return paths


def profile_tables(frame: DataFrame, label: str = "is_canceled",
                   segment: str = "market_segment") -> dict[str, DataFrame]:
    """Every table behind the profile report, for the columns the frame has."""
    cols = set(frame.columns)
    t: dict[str, DataFrame] = {
        "table_shape": P.table_shape(frame),
        "column_profile": P.column_profile(frame),
        "missing_ranking": P.missing_ranking(frame),
        "numeric_describe": P.numeric_describe(frame, DESCRIBE_COLS),
        "categorical_describe": P.categorical_describe(
            frame, [c for c, d in frame.dtypes if d == "string"]),
        "category_counts": P.value_counts(frame, COUNT_COLS),
        "top_modes": P.modes(frame, ["hotel", segment]),
        "correlation_lower": P.lower_triangle(P.correlation_matrix(frame, HEAT_COLS)),
        "histogram": D.histogram(frame, [c for c in HIST_COLS if c in cols]),
        "density_curve": D.density(frame, [c for c in HIST_COLS if c in cols]),
    }
    if "country" in cols:
        t["top_countries"] = P.top_k(frame, "country", 10)
    if label in cols:
        if "lead_time" in cols:
            t["median_lead_by_label"] = exact_quantiles(frame, ["lead_time"], [0.5], by=[label])
            t["lead_time_density_by_label"] = D.density_by(frame, "lead_time", [label])
        t["box_stats"] = D.box_stats(frame, [c for c in BOX_COLS if c in cols], [label])
        if segment in cols:
            rates = P.group_rate(frame, segment, label, "cancel_rate")
            t["segment_rates"] = rates
            t["segment_rank_picks"] = P.rank_picks(rates, segment, "cancel_rate")
        for other, name in (("deposit_type", "deposit_by_label"),
                            ("total_of_special_requests", "requests_by_label")):
            if other in cols:
                t[name] = P.crosstab_counts(frame, other, label)
        if "deposit_type" in cols:
            t["non_refund_cancel_rate"] = P.conditional_mean(frame, "deposit_type", "Non Refund",
                                                             label, "cancel_rate")
    means = [F.avg(c).alias(f"mean_{c}") for c in ("lead_time", "adr") if c in cols]
    if means:
        t["global_means"] = frame.agg(*means)
    return t


def profile_job(spark: SparkSession, raw: DataFrame, out_dir: str) -> dict[str, str]:
    """Profile frame persisted once; each table written as parquet under ``out_dir``."""
    frame = as_text(profile_features(clean_columns(raw))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        paths = {}
        for name, table in profile_tables(frame).items():
            paths[name] = os.path.join(out_dir, name)
            table.write.mode("overwrite").parquet(paths[name])
    finally:
        frame.unpersist()
    return paths


def training_data_from_processed(spark: SparkSession, train_path: str, test_path: str,
                                 target: str, folds: int, out_dir: str,
                                 fmt: str = "parquet", preprocessor_path: str | None = None) -> TrainingData:
    """Processed tables -> feature vector, label, stratified fold column; written once.

    With the saved preprocessor that made the tables, models can score raw records.
    """
    train, feats = read_processed(spark, train_path, target, fmt)
    test, _ = read_processed(spark, test_path, target, fmt)
    vectors = feats == ["features"]
    first = FeatureVector([] if vectors else feats, "features")
    if preprocessor_path:
        prep = load_preprocessor(preprocessor_path)
        if not vectors and prep.feature_columns != feats:
            raise ValueError(f"the preprocessor at {preprocessor_path} did not make the table at {train_path}")
        first = prep.copy({prep.outputCol: "features"})
    tagged = assign_split(train, target, 0.0, folds=folds).drop("part")
    for part, frame in (("train", tagged), ("test", test)):
        keep = ["label", "features"] + (["fold"] if part == "train" else [])
        whole = frame if vectors else FeatureVector(feats, "features").transform(frame)
        (whole.withColumn("label", F.col(target).cast("double"))
         .select(*keep).write.mode("overwrite").parquet(os.path.join(out_dir, part)))
    tr = spark.read.parquet(os.path.join(out_dir, "train")).persist(StorageLevel.MEMORY_AND_DISK)
    te = spark.read.parquet(os.path.join(out_dir, "test")).persist(StorageLevel.MEMORY_AND_DISK)
    return TrainingData(tr, te, first, [] if vectors else feats, None, target, out_dir)


def train_job(spark: SparkSession, train_path: str, test_path: str, out_dir: str,
              target: str = "is_canceled", model: str = "Auto",
              cfg: SearchConfig = SearchConfig(), fmt: str = "parquet", preprocessor_path: str | None = None) -> DataFrame:
    """Named preset: search, evaluate, save ``<name>`` pipeline.  Auto: every preset, best saved, all compared."""
    data = training_data_from_processed(spark, train_path, test_path, target, cfg.folds,
                                        out_dir, fmt, preprocessor_path)
    try:
        if model == "Auto":
            summary, _, _ = auto_select(spark, data, cfg, out_dir=out_dir)
        else:
            row = run_model(spark, model, data, cfg, out_dir)
            save_model(scoring_pipeline(data.preprocessor, row["_model"]), os.path.join(out_dir, row["Model"]))
            summary = summary_frame(spark, [row])
        write_comparison(spark, out_dir)
    finally:
        data.train.unpersist()
        data.test.unpersist()
    return summary


def run_job(spark: SparkSession, raw: DataFrame, out_dir: str, target: str = "is_canceled", model: str = "Auto",
            cfg: SearchConfig = SearchConfig(), test_size: float = 0.3, scale_method: str = "minmax",
            drop: Sequence[str] = ()) -> DataFrame:
    """Raw bookings to a pipeline that scores raw records: preprocess, then train."""
    made = preprocess_job(spark, raw, out_dir, target, test_size, cfg.seed, scale_method, drop=drop)
    return train_job(spark, made["train"], made["test"], os.path.join(out_dir, "models"), clean_name(target), model, cfg,
                     preprocessor_path=made["preprocessor"])


def score_job(spark: SparkSession, model_path: str, records: DataFrame, out_path: str,
              processed: bool = False, keep: Sequence[str] = ()) -> str:
    pipeline = load_pipeline(model_path)
    score_records(pipeline, records, processed, keep).write.mode("overwrite").parquet(out_path)
    return out_path
