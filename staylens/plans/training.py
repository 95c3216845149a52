"""Preprocess -> split -> search -> evaluate -> select, as Spark jobs.

Stages talk through tables in the shared folder (``spark.checkpoint.dir``):
the split rows and the transformed train / test rows are written once and
read back, which cuts lineage before the many passes of model fitting and
lets a lost executor recompute from files, not from the raw joins.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import DEFAULT_DROP, dedupe
from ..operators.evaluate import area_of, classification_report, confusion_matrix, curve_of, ordered_scores
from ..operators.preprocess import BookingPreprocessor
from ..operators.split import assign_split
from ..operators.train import MODEL_ORDER, SearchConfig, importance_table, positive_probability, resolve, search
from ..session import scratch_path, shared_dir, stored
from ..sources.files import read_evaluations, save_model, write_evaluation, write_table
from .scoring import scoring_pipeline


@dataclass
class TrainingData:
    train: DataFrame
    test: DataFrame
    preprocessor: object
    features: list[str]
    id_col: str | None
    label_col: str
    base: str


def prepare_training_data(spark: SparkSession, raw: DataFrame, label_col: str, id_col: str,
                          test_size: float = 0.3, folds: int = 5, drop=None,
                          remove_duplicates: bool = True, out_dir: str | None = None,
                          hash_method: str = "xxhash64") -> TrainingData:
    """Dedupe raw rows (label included), stratified split + folds, fit on train only."""
    base = out_dir or scratch_path(spark, "training")
    # Written before the split, which reads the rows twice.
    rows = stored(dedupe(raw) if remove_duplicates else raw, "rows")
    keys = [c for c in rows.columns if c != label_col]
    tagged = assign_split(rows, label_col, test_size, folds=folds, key_cols=keys,
                          hash_method=hash_method)
    tagged.write.mode("overwrite").parquet(os.path.join(base, "split"))
    tagged = spark.read.parquet(os.path.join(base, "split"))
    train_raw = tagged.where(F.col("part") == "train").drop("part")
    test_raw = tagged.where(F.col("part") == "test").drop("part", "fold")
    prep = BookingPreprocessor(labelCol=label_col, passthroughCols=[id_col, "fold"],
                               dropColumns=list(drop or DEFAULT_DROP), outputCol="features").fit(train_raw)
    feats = prep.feature_columns if prep.wide else []
    for part, frame in (("train", train_raw), ("test", test_raw)):
        out = prep.transform(frame).withColumn("label", F.col(label_col).cast("double"))
        keep = [id_col, "label", "features"] + (["fold"] if part == "train" else [])
        out.select(*keep).write.mode("overwrite").parquet(os.path.join(base, part))
    train, test = (spark.read.parquet(os.path.join(base, part)) for part in ("train", "test"))
    return TrainingData(train, test, prep, feats, id_col, label_col, base)


def _report_dict(pred: DataFrame) -> dict:
    rep = classification_report(pred.select(F.col("label").cast("int").alias("y"),
                                            F.col("prediction").cast("int").alias("p")), "y", "p")
    return {r["name"]: {"precision": r["precision"], "recall": r["recall"],
                        "f1_score": r["f1_score"], "support": r["support"]} for r in rep.collect()}


def _confusion(pred: DataFrame) -> list[list[int]]:
    cm = confusion_matrix(pred.select(F.col("label").cast("int").alias("y"),
                                      F.col("prediction").cast("int").alias("p")), "y", "p").collect()
    classes = sorted({r["actual"] for r in cm})
    cell = {(r["actual"], r["predicted"]): int(r["count"]) for r in cm}
    return [[cell.get((a, b), 0) for b in classes] for a in classes]


def evaluate_scores(spark: SparkSession, name: str, scored: DataFrame, cv_score: float, out_dir: str) -> dict:
    """Evaluates (label, prediction, score) rows, stores the record and the ROC points, returns the summary row."""
    report = _report_dict(scored)
    roc_path = os.path.join(out_dir, "roc", name)
    points = ordered_scores(scored, "label", "score", pos_label=1.0)
    curve_of(points).write.mode("overwrite").parquet(roc_path)
    accuracy = report["accuracy"]["f1_score"]
    write_evaluation(spark, {"model_name": name, "best_cv_score": cv_score, "accuracy": accuracy, "report": report,
                             "confusion_matrix": _confusion(scored), "roc_path": roc_path,
                             "auc": area_of(points).first()["auc"]},
                     os.path.join(out_dir, "evaluations", name))
    per_class = {f"{measure}_{c}": report.get(c, {}).get(key)
                 for c in ("0", "1") for measure, key in PER_CLASS}
    return {"Model": name, "Best_CV_Score": cv_score, "Accuracy": accuracy, **per_class,
            "Macro_Avg_F1": report["macro avg"]["f1_score"]}


def run_model(spark: SparkSession, name: str, data: TrainingData, cfg: SearchConfig,
              out_dir: str | None = None) -> dict:
    """Search, predict the test rows once, evaluate, store evaluation / ROC / importances."""
    name = resolve(name)
    if data is None or data.train is None or data.test is None:
        raise ValueError("there is no training data: prepare it before a search")
    out_dir = out_dir or data.base
    shared_dir(spark)  # tree learners checkpoint their cached node ids there
    model, cv_score, point = search(name, data.train, cfg)
    ids = [data.id_col] if data.id_col else []
    scored = (model.transform(data.test)
              .select(*ids, "label", "prediction", positive_probability().alias("score"))
              .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        row = evaluate_scores(spark, name, scored, cv_score, out_dir)
    finally:
        scored.unpersist()
    write_table(importance_table(spark, model, data.features), os.path.join(out_dir, "importance", name))
    return row | {"_model": model, "_point": point}


# The names of the comparison table.
PER_CLASS = (("Precision", "precision"), ("Recall", "recall"), ("F1_Score", "f1_score"))
SUMMARY_COLS = ["Model", "Best_CV_Score", "Accuracy", "Precision_0", "Recall_0", "F1_Score_0",
                "Precision_1", "Recall_1", "F1_Score_1", "Macro_Avg_F1"]
SUMMARY_SCHEMA = ", ".join(f"{c} {'string' if c == 'Model' else 'double'}" for c in SUMMARY_COLS)


def summary_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """One row per model (driver-side results of the searches), best CV score first."""
    data = [tuple(r[c] for c in SUMMARY_COLS) for r in rows]
    return spark.createDataFrame(data, SUMMARY_SCHEMA).orderBy(F.desc("Best_CV_Score"), "Model")


def attempt(spark: SparkSession, name: str, data: TrainingData, cfg: SearchConfig, out_dir: str) -> dict:
    """A preset's row, or its error: one preset must not stop the others."""
    try:
        return run_model(spark, name, data, cfg, out_dir)
    except Exception as err:  # noqa: BLE001
        return {"Model": resolve(name), "_error": f"{type(err).__name__}: {err}"[:500]}


def auto_select(spark: SparkSession, data: TrainingData, cfg: SearchConfig,
                names=MODEL_ORDER, out_dir: str | None = None) -> tuple[DataFrame, str, PipelineModel]:
    """Every preset; of those that ran, the highest CV score is best (of equal ones the first named).

    Writes the comparison table and the best scoring pipeline (preprocessor +
    classifier); returns (summary, best name, pipeline).
    """
    out_dir = out_dir or data.base
    tried = [attempt(spark, name, data, cfg, out_dir) for name in names]
    rows = [r for r in tried if "_error" not in r]
    if not rows:
        raise ValueError("no preset could be trained: " + "; ".join(f"{r['Model']}: {r['_error']}" for r in tried))
    best = max(enumerate(rows), key=lambda x: (x[1]["Best_CV_Score"], -x[0]))[1]
    summary = summary_frame(spark, rows)
    write_table(summary, os.path.join(out_dir, "model_comparison_summary"))
    pipeline = scoring_pipeline(data.preprocessor, best["_model"])
    save_model(pipeline, os.path.join(out_dir, "best_model"))
    return summary, best["Model"], pipeline


# ---------------------------------------------------------------- comparison of stored evaluations
def accuracy_ranking(evaluations: DataFrame) -> DataFrame:
    return evaluations.select("model_name", "accuracy").orderBy(F.desc("accuracy"), "model_name")


def roc_comparison(evaluations: DataFrame) -> DataFrame:
    """ROC points of every stored evaluation with its AUC; evaluations without points are left out (one row a model)."""
    spark = evaluations.sparkSession
    out = spark.createDataFrame([], "model_name string, threshold double, fpr double, tpr double, auc double")
    for r in evaluations.where("roc_path IS NOT NULL").select("model_name", "auc", "roc_path").collect():
        out = out.unionByName(spark.read.parquet(r["roc_path"]).select(
            F.lit(r["model_name"]).alias("model_name"), "threshold", "fpr", "tpr", F.lit(r["auc"]).alias("auc")))
    return out


def confusion_long(evaluations: DataFrame) -> DataFrame:
    """Confusion matrices of all evaluations as (model_name, actual, predicted, count)."""
    rows = evaluations.select("model_name", F.posexplode("confusion_matrix").alias("actual", "_row"))
    return rows.select("model_name", "actual", F.posexplode("_row").alias("predicted", "count"))


def write_comparison(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """The comparison tables of all evaluations stored below ``out_dir``."""
    evaluations = read_evaluations(spark, os.path.join(out_dir, "evaluations", "*"))
    tables = {"accuracy_ranking": accuracy_ranking, "roc_comparison": roc_comparison, "confusion_matrices": confusion_long}
    paths = {}
    for name, table in tables.items():
        paths[name] = os.path.join(out_dir, "comparison", name)
        write_table(table(evaluations), paths[name])
    return paths
