"""Classifier evaluation from (label, prediction, score) columns.

Everything starts from one group-by: (label, prediction) counts for the
report and the confusion matrix, (score) -> positive / negative counts for
the ROC curve.  Those tables are bounded by classes resp. distinct scores;
the ROC prefix sums run through :func:`ranks.running_sums`, never in one task
over all scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import running_sums


def pair_counts(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    return df.groupBy(F.col(label_col).alias("actual"), F.col(pred_col).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """(actual, predicted, count) over every pair of classes seen in labels or predictions."""
    counts = pair_counts(df, label_col, pred_col)
    # One row a class before they meet in an array.
    classes = (counts.select(F.explode(F.array("actual", "predicted")).alias("c")).distinct()
               .agg(F.array_sort(F.collect_list("c")).alias("_cls")))
    grid = (classes.select(F.explode("_cls").alias("actual"), "_cls")
            .select("actual", F.explode("_cls").alias("predicted")))
    return (grid.join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce("count", F.lit(0)).alias("count")))


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def classification_report(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """Per class precision, recall, F1, support; macro and weighted averages; accuracy.

    Zero division gives 0.  Rows: class name, 'macro avg', 'weighted avg',
    'accuracy' (f1_score holds the accuracy, support the row count).
    """
    counts = pair_counts(df, label_col, pred_col)
    both = F.array(
        F.struct(F.col("actual").alias("cls"), F.col("count").alias("na"),
                 F.lit(0).cast("long").alias("np"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("count"))
                 .otherwise(F.lit(0)).cast("long").alias("tp")),
        F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("long").alias("na"),
                 F.col("count").alias("np"), F.lit(0).cast("long").alias("tp")))
    per = (counts.select(F.explode(both).alias("_e")).select("_e.*")
           .groupBy("cls").agg(F.sum("na").alias("na"), F.sum("np").alias("np"),
                               F.sum("tp").alias("tp")))
    pr = _safe_div(F.col("tp"), F.col("np"))
    rc = _safe_div(F.col("tp"), F.col("na"))
    per = per.select(F.col("cls").cast("string").alias("name"), pr.alias("precision"),
                     rc.alias("recall"), F.col("na").alias("support"), "tp")
    f1 = F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        F.lit(2) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    per = per.withColumn("f1_score", f1)
    n = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("name"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1_score").alias("f1_score"),
                    n.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("name"),
                       (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                       (F.sum(F.col("f1_score") * F.col("support")) / n).alias("f1_score"),
                       n.alias("support"))
    accuracy = per.agg(F.lit("accuracy").alias("name"), F.lit(None).cast("double").alias("precision"),
                       F.lit(None).cast("double").alias("recall"),
                       (F.sum("tp") / n).alias("f1_score"), n.alias("support"))
    cols = ["name", "precision", "recall", "f1_score", "support"]
    return (per.select(*cols).unionByName(macro.select(*cols)).unionByName(weighted.select(*cols))
            .unionByName(accuracy.select(*cols)))


def score_counts(df: DataFrame, label_col: str, score_col: str, pos_label=1) -> DataFrame:
    is_pos = F.col(label_col) == F.lit(pos_label)
    return df.where(F.col(score_col).isNotNull()).groupBy(F.col(score_col).alias("score")).agg(
        F.count_if(is_pos).alias("pos"), F.count_if(~is_pos).alias("neg"))


def ordered_scores(df: DataFrame, label_col: str, score_col: str, pos_label=1) -> DataFrame:
    """Distinct scores with their counts, the counts before them, the next score's, and the totals.

    One pass over the rows; the curve and the area both follow from it.
    """
    return running_sums(score_counts(df, label_col, score_col, pos_label), [], "score", ["pos", "neg"],
                        descending=True, with_next=True)


def curve_of(points: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """:func:`roc_curve` of :func:`ordered_scores`."""
    tps = F.col("pos_before") + F.col("pos")
    fps = F.col("neg_before") + F.col("neg")
    keep = F.lit(True)
    if drop_intermediate:
        first = (F.col("pos_before") + F.col("neg_before")) == 0
        last = F.col("pos_next").isNull()
        bend = (F.col("pos_next") != F.col("pos")) | (F.col("neg_next") != F.col("neg"))
        keep = first | last | bend
    curve = points.where(keep).select(F.col("score").alias("threshold"),
                                      F.try_divide(fps, F.col("neg_total")).alias("fpr"),
                                      F.try_divide(tps, F.col("pos_total")).alias("tpr"))
    start = points.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(curve)


def area_of(points: DataFrame) -> DataFrame:
    """:func:`roc_auc` of :func:`ordered_scores`."""
    area = F.sum(F.col("neg") * (F.lit(2.0) * F.col("pos_before") + F.col("pos")))
    return points.agg(F.try_divide(area, F.lit(2.0) * F.sum("pos") * F.sum("neg")).alias("auc"))


def roc_curve(df: DataFrame, label_col: str, score_col: str, pos_label=1,
              drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) at each distinct score, high to low, after a (inf, 0, 0) start.

    With ``drop_intermediate`` a point is kept only when the slope changes
    on either side of it (the first and last points always stay); for
    distinct scores that is: its (pos, neg) counts differ from the next
    score's counts.  With one class only, the rate of the other is null.
    """
    return curve_of(ordered_scores(df, label_col, score_col, pos_label), drop_intermediate)


def roc_auc(df: DataFrame, label_col: str, score_col: str, pos_label=1) -> DataFrame:
    """Trapezoid area under the ROC curve (dropping collinear points does not change it); null for one class."""
    return area_of(ordered_scores(df, label_col, score_col, pos_label))
