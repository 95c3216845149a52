"""Evaluation store, comparison and scoring queries.

A model search is not SQL and takes hours, so it is a job (:mod:`jobs`) and
not a query.  The comparison queries run the same evaluation store over three
stated scores of all bookings, so their rows have an oracle.  Two queries fit
one stated point of the random forest's grid and are checked rows-only.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators.columns import DEFAULT_DROP
from ..operators.preprocess import BookingPreprocessor
from ..operators.split import assign_split
from ..operators.train import SearchConfig, build, importance_table
from ..operators.tree_expr import FOREST, Ensemble, TreeExpression, probability_sql
from ..session import scratch_path, shared_dir
from ..sources.files import flatten_evaluation, load_pipeline, read_evaluations, save_model
from ..sources.tables import bookings, with_signal_label
from . import training
from .catalog import r6, register
from .oracle import PREPARED_CTE, split_ctes, with_ctes
from .q_fit import prep_ctes, scaled_sql
from .scoring import score_frame, scoring_pipeline
from .training import SUMMARY_COLS, evaluate_scores, prepare_training_data, summary_frame

ID, LABEL = "booking_id", "label_signal"
#: Stated scores: (id * a) mod m, over m - 1; prediction 1 from 0.5 on.  The CV score stands for one.
SCORERS = {"by_101": (1, 101, 0.5), "by_89": (7, 89, 0.25), "by_97": (3, 97, 0.75)}
#: A point of the random forest's grid, fitted on all rows of the train split.
POINT = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 1, "bootstrap": True}
FIT = SearchConfig()


def training_raw(spark, sf_dir):
    """Bookings with the learnable label; the raw status is not a feature here."""
    return with_signal_label(bookings(spark, sf_dir)).drop("is_canceled")


def stored_evaluations(spark, sf_dir) -> tuple[str, list[dict]]:
    """Evaluates every stated score over all bookings; (folder, summary rows)."""
    base = scratch_path(spark, "evaluations")
    rows = bookings(spark, sf_dir).select(F.col(ID), F.col("is_canceled").cast("double").alias("label"))
    found = []
    for name, (a, m, cv) in SCORERS.items():
        scored = rows.withColumn("score", ((F.col(ID) * a) % m) / F.lit(float(m - 1)))
        scored = scored.withColumn("prediction", (F.col("score") >= 0.5).cast("double"))
        found.append(evaluate_scores(spark, name, scored, cv, base))
    return base, found


def _evaluations(spark, sf_dir):
    base, _ = stored_evaluations(spark, sf_dir)
    return read_evaluations(spark, os.path.join(base, "evaluations", "*"))


_SCORES = ",\n".join(f"  SELECT '{n}' AS m, CAST({cv} AS DOUBLE) AS cv, is_canceled AS y, (booking_id * {a} % {k}) / {float(k - 1)} AS s "
                    "FROM bookings" + (" UNION ALL" if i < len(SCORERS) - 1 else "")
                    for i, (n, (a, k, cv)) in enumerate(SCORERS.items())).replace(",\n", "\n")
_CTES = (f"""
sc AS (SELECT m, cv, y, s, CAST(s >= 0.5 AS INT) AS p FROM (
{_SCORES}))""", """
pc AS (SELECT m, cv, c, count(*) FILTER (WHERE y = c AND p = c) AS tp, count(*) FILTER (WHERE p = c) AS np,
  count(*) FILTER (WHERE y = c) AS na FROM sc, (VALUES (0), (1)) k(c) GROUP BY m, cv, c)""", """
pr AS (SELECT *, CASE WHEN np = 0 THEN 0.0 ELSE tp / np END AS pre, CASE WHEN na = 0 THEN 0.0 ELSE tp / na END AS rec FROM pc)""", """
f1 AS (SELECT *, CASE WHEN pre + rec = 0 THEN 0.0 ELSE 2 * pre * rec / (pre + rec) END AS f FROM pr)""", """
su AS (SELECT m, cv, sum(tp) / sum(na) AS acc, avg(f) AS macro FROM f1 GROUP BY m, cv)""", """
g AS (SELECT m, s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM sc GROUP BY m, s)""", """
cu AS (SELECT m, s, pos, neg, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, lead(pos) OVER w AS pn, lead(neg) OVER w AS nn,
  row_number() OVER w AS i FROM g WINDOW w AS (PARTITION BY m ORDER BY s DESC))""", """
au AS (SELECT m, sum(pos) AS tp, sum(neg) AS tn, sum(neg * (2.0 * (tps - pos) + pos)) / (2.0 * sum(pos) * sum(neg)) AS auc
  FROM cu GROUP BY m)""")


@register("model_selection_summary", with_ctes("""
SELECT su.m AS "Model", round(su.cv, 6) AS "Best_CV_Score", round(acc, 6) AS "Accuracy",
  round(a.pre, 6) AS "Precision_0", round(a.rec, 6) AS "Recall_0", round(a.f, 6) AS "F1_Score_0",
  round(b.pre, 6) AS "Precision_1", round(b.rec, 6) AS "Recall_1", round(b.f, 6) AS "F1_Score_1", round(macro, 6) AS "Macro_Avg_F1"
FROM su JOIN f1 a ON a.m = su.m AND a.c = 0 JOIN f1 b ON b.m = su.m AND b.c = 1""", *_CTES))
def model_selection_summary(spark, sf_dir):
    """One row per evaluation (CV score, accuracy, per-class precision / recall / F1, macro F1)."""
    table = summary_frame(spark, stored_evaluations(spark, sf_dir)[1])
    return table.select("Model", *[r6(c).alias(c) for c in SUMMARY_COLS if c != "Model"])


@register("accuracy_ranking", with_ctes("SELECT m AS model_name, round(acc, 6) AS accuracy FROM su", *_CTES))
def accuracy_ranking(spark, sf_dir):
    return training.accuracy_ranking(_evaluations(spark, sf_dir)).select("model_name", r6("accuracy").alias("accuracy"))


@register("roc_comparison", with_ctes("""
SELECT au.m AS model_name, CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr, round(auc, 6) AS auc
FROM au
UNION ALL SELECT au.m, round(s, 6), round(fps / tn, 6), round(tps / tp, 6), round(auc, 6) FROM cu JOIN au ON au.m = cu.m
WHERE i = 1 OR pn IS NULL OR pn <> pos OR nn <> neg""", *_CTES))
def roc_comparison(spark, sf_dir):
    """ROC points of every stored evaluation with its AUC; evaluations without points are left out."""
    out = training.roc_comparison(_evaluations(spark, sf_dir))
    return out.select("model_name", *[r6(c).alias(c) for c in ("threshold", "fpr", "tpr", "auc")])


@register("confusion_long", with_ctes("""
SELECT m AS model_name, CAST(a AS INT) AS actual, CAST(b AS INT) AS predicted, count(*) FILTER (WHERE y = a AND p = b) AS "count"
FROM sc, (VALUES (0), (1)) i(a), (VALUES (0), (1)) j(b) GROUP BY m, a, b""", *_CTES))
def confusion_long(spark, sf_dir):
    """Confusion matrices of all evaluations as (model_name, actual, predicted, count)."""
    return training.confusion_long(_evaluations(spark, sf_dir))


@register("evaluation_flatten", with_ctes("""
SELECT m AS model_name, 'best_cv_score' AS "key", NULL AS sub_key, round(cv, 6) AS number, NULL AS note FROM su
UNION ALL SELECT m, 'accuracy', NULL, round(acc, 6), NULL FROM su
UNION ALL SELECT m, 'auc', NULL, round(auc, 6), NULL FROM au
UNION ALL SELECT m, 'confusion_matrix', NULL, NULL, 'List with 2 items' FROM su
UNION ALL SELECT m, 'report', CAST(c AS VARCHAR), round(f, 6), NULL FROM f1
UNION ALL SELECT m, 'report', 'macro avg', round(macro, 6), NULL FROM su
UNION ALL SELECT m, 'report', 'weighted avg', round(sum(f * na) / sum(na), 6), NULL FROM f1 GROUP BY m
UNION ALL SELECT m, 'report', 'accuracy', round(acc, 6), NULL FROM su""", *_CTES))
def evaluation_flatten(spark, sf_dir):
    """Flattened records: numbers of the scalars, the F1 of each report line; folders differ by run and are left out."""
    flat = flatten_evaluation(_evaluations(spark, sf_dir)).where("key <> 'roc_path'")
    number = F.when(F.col("key") == "report", F.get_json_object("value", "$.f1_score")).otherwise(F.col("value"))
    note = F.when(F.col("key") == "confusion_matrix", F.col("value"))
    return flat.select("model_name", "key", "sub_key", F.round(number.try_cast("double"), 6).alias("number"), note.alias("note"))


def _fitted(spark, sf_dir):
    data = prepare_training_data(spark, training_raw(spark, sf_dir), LABEL, ID, test_size=0.3, folds=3,
                                 drop=list(DEFAULT_DROP))
    shared_dir(spark)
    # The rows of a fit are a stored table; the learner reads it a few times and holds only its binned points.
    return data, build("random_forest", POINT, FIT).fit(data.train)


@register("feature_importance_top5")
def feature_importance_top5(spark, sf_dir):
    """Top 5 importances of the forest fitted on all train rows (a top-k report)."""
    data, model = _fitted(spark, sf_dir)
    return importance_table(spark, model, data.features).limit(5)


@register("score_fitted_rows")
def score_fitted_rows(spark, sf_dir):
    """Preprocessor and forest, fitted on all train rows, score the raw test rows: one output row per input row."""
    data, model = _fitted(spark, sf_dir)
    split = spark.read.parquet(os.path.join(data.base, "split"))
    test_raw = split.where(F.col("part") == "test").drop("part", "fold", LABEL)
    return score_frame(scoring_pipeline(data.preprocessor, model), test_raw, keep=[ID])


#: A stated forest over processed features (scaled to 0..1): the trees that scoring is checked with.
STATED_FEATURES = ["lead_time", "adr", "total_guests", "previous_cancellations", "deposit_type_Non Refund",
                   "market_segment_BUILDING", "total_nights", "hotel_City Hotel", "total_of_special_requests"]
STATED = Ensemble(FOREST, [
    (0, 0.52, (4, 0.5, (3, 0.4, 0.18, 0.44), 0.91), (8, 0.7, (1, 0.33, 0.63, 0.83), 0.37)),
    (1, 0.41, (7, 0.5, 0.22, (6, 0.26, 0.35, (2, 0.45, 0.58, 0.74))), (3, 0.9, 0.56, 0.97)),
    (6, 0.31, (0, 0.27, 0.12, 0.41), (5, 0.5, (8, 0.3, 0.86, 0.49), (1, 0.62, 0.77, 0.95))),
], [1.0, 2.0, 1.5])


@register("score_test_rows", with_ctes(f"""
SELECT booking_id, CAST(p > 0.5 AS INT) AS prediction, CASE WHEN p > 0.5 THEN 'Canceled' ELSE 'Not canceled' END AS label,
  round(p, 6) AS probability, CASE WHEN p >= 0.7 THEN 'High' WHEN p >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_level
FROM (SELECT booking_id, {probability_sql(STATED, lambda i: f"f{i}")} AS p FROM wide)""", PREPARED_CTE,
    *split_ctes("prepared", "is_canceled", ID), *prep_ctes("SELECT * FROM tagged WHERE part = 'train'",
                                                           "SELECT * FROM tagged WHERE part = 'test'"), f"""
sc_all AS ({scaled_sql("minmax", None)})""", f"""
wide AS (SELECT booking_id, {", ".join(f"max(CASE WHEN feature = '{c}' THEN value END) AS f{i}" for i, c in enumerate(STATED_FEATURES))}
  FROM sc_all GROUP BY booking_id)"""))
def score_test_rows(spark, sf_dir):
    """Raw test bookings through contract, preprocessor (fitted on the train split) and a stated forest, saved and loaded."""
    tagged = assign_split(bookings(spark, sf_dir), "is_canceled", 0.3, key_cols=[ID], hash_method="md5")
    prep = BookingPreprocessor(labelCol="is_canceled", passthroughCols=[ID]).fit(tagged.where("part = 'train'").drop("part"))
    test = tagged.where("part = 'test'").drop("part", "is_canceled")
    path = save_model(scoring_pipeline(prep, TreeExpression(STATED, STATED_FEATURES)), scratch_path(spark, "pipeline"))
    scored = score_frame(load_pipeline(path), test, keep=[ID])
    return scored.select(ID, "prediction", "label", r6("probability").alias("probability"), "risk_level")
