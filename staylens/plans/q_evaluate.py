"""Evaluation queries on a model-free deterministic score (S-checkable without training)."""

from __future__ import annotations

from ..operators import evaluate as EV
from ..sources.tables import bookings, deterministic_score
from .catalog import r6, register
from .oracle import with_ctes

SCORED_CTE = """
scored AS (SELECT is_canceled AS y, CAST((booking_id % 101) / 100.0 AS DOUBLE) AS score,
  CAST(CAST((booking_id % 101) / 100.0 AS DOUBLE) >= 0.5 AS INT) AS p FROM bookings)"""


def _scored(spark, sf_dir):
    return deterministic_score(bookings(spark, sf_dir).select("booking_id", "is_canceled"))


@register("confusion_matrix", with_ctes("""
SELECT a.c AS actual, b.c AS predicted,
  (SELECT count(*) FROM scored WHERE y = a.c AND p = b.c) AS "count"
FROM classes a, classes b""", SCORED_CTE, """
classes AS (SELECT y AS c FROM scored UNION SELECT p FROM scored)"""))
def confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(_scored(spark, sf_dir), "is_canceled", "prediction")


@register("classification_report", with_ctes("""
SELECT CAST(c AS VARCHAR) AS name, round(pr, 6) AS "precision", round(rc, 6) AS recall,
  round(f1, 6) AS f1_score, na AS support FROM m2
UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(rc), 6), round(avg(f1), 6), sum(na) FROM m2
UNION ALL SELECT 'weighted avg', round(sum(pr * na) / sum(na), 6), round(sum(rc * na) / sum(na), 6),
  round(sum(f1 * na) / sum(na), 6), sum(na) FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(na), 6), sum(na) FROM m2""", SCORED_CTE, """
classes AS (SELECT y AS c FROM scored UNION SELECT p FROM scored)""", """
per AS (SELECT c.c, count(*) FILTER (WHERE s.y = c.c AND s.p = c.c) AS tp,
  count(*) FILTER (WHERE s.p = c.c) AS np, count(*) FILTER (WHERE s.y = c.c) AS na
  FROM classes c, scored s GROUP BY c.c)""", """
m AS (SELECT c, tp, na, CASE WHEN np = 0 THEN 0.0 ELSE tp / np END AS pr,
  CASE WHEN na = 0 THEN 0.0 ELSE tp / na END AS rc FROM per)""", """
m2 AS (SELECT *, CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END AS f1 FROM m)"""))
def classification_report(spark, sf_dir):
    rep = EV.classification_report(_scored(spark, sf_dir), "is_canceled", "prediction")
    return rep.select("name", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1_score").alias("f1_score"), "support")


@register("roc_curve", with_ctes("""
SELECT CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL
SELECT score, round(fps / t.n, 6), round(tps / t.p, 6) FROM c, t
WHERE i = 1 OR pos_next IS NULL OR pos_next <> pos OR neg_next <> neg""", SCORED_CTE, """
s AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
  FROM scored GROUP BY score)""", """
c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tps,
  sum(neg) OVER (ORDER BY score DESC) AS fps, lead(pos) OVER (ORDER BY score DESC) AS pos_next,
  lead(neg) OVER (ORDER BY score DESC) AS neg_next, row_number() OVER (ORDER BY score DESC) AS i FROM s)""",
"""
t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM s)"""))
def roc_curve(spark, sf_dir):
    curve = EV.roc_curve(_scored(spark, sf_dir), "is_canceled", "score")
    return curve.select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@register("roc_auc", with_ctes("""
SELECT round(sum(neg * (2.0 * (tps - pos) + pos)) / (2.0 * sum(pos) * sum(neg)), 6) AS auc FROM c""",
    SCORED_CTE, """
s AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
  FROM scored GROUP BY score)""", """
c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tps FROM s)"""))
def roc_auc(spark, sf_dir):
    return EV.roc_auc(_scored(spark, sf_dir), "is_canceled", "score").select(
        r6("auc").alias("auc"))
