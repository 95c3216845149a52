"""Evaluation against brute force and Spark's own binary evaluator."""

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from staylens.operators.evaluate import classification_report, confusion_matrix, roc_auc, roc_curve


def _brute_roc(y, s):
    order = np.argsort(-s, kind="mergesort")
    s, y = s[order], y[order]
    idx = np.r_[np.where(np.diff(s))[0], len(s) - 1]
    tps = np.cumsum(y)[idx]
    fps = 1 + idx - tps
    keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
    fps, tps = np.r_[0, fps[keep]], np.r_[0, tps[keep]]
    return fps / fps[-1], tps / tps[-1]


def test_roc_and_auc(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 2000)
    s = np.round(np.clip(0.3 * y + rng.normal(0.4, 0.2, 2000), 0, 1), 2)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s, "p": (s >= 0.5).astype(int)}))
    fpr, tpr = _brute_roc(y, s)
    got = roc_curve(df, "y", "s").toPandas().sort_values(["fpr", "tpr"])
    assert len(got) == len(fpr)
    assert np.allclose(got["fpr"].values, fpr) and np.allclose(got["tpr"].values, tpr)
    auc = roc_auc(df, "y", "s").first()["auc"]
    assert abs(auc - np.trapezoid(tpr, fpr)) < 1e-12
    ev = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0)
    assert abs(auc - ev.evaluate(df.selectExpr("cast(y as double) y", "s"))) < 1e-9


def test_report_and_confusion(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (1, 1), (0, 1)], "y int, p int")
    rep = {r["name"]: r for r in classification_report(df, "y", "p").collect()}
    assert abs(rep["1"]["precision"] - 2 / 3) < 1e-12 and abs(rep["1"]["recall"] - 2 / 3) < 1e-12
    assert rep["accuracy"]["f1_score"] == 4 / 6 and rep["accuracy"]["support"] == 6
    assert abs(rep["weighted avg"]["f1_score"] - 2 / 3) < 1e-12
    cm = {(r["actual"], r["predicted"]): r["count"] for r in confusion_matrix(df, "y", "p").collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 2}


def test_zero_division_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y int, p int")
    rep = {r["name"]: r for r in classification_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["f1_score"] == 0.0
