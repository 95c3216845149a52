"""Prediction label text and risk level as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scoring contract.
CANCELED_TEXT = "Canceled"
NOT_CANCELED_TEXT = "Not canceled"
HIGH_RISK_AT = 0.7
MEDIUM_RISK_AT = 0.4


def label_text(prediction: Column | str) -> Column:
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.when(pred == 1, CANCELED_TEXT).otherwise(NOT_CANCELED_TEXT)


def risk_level(probability: Column | str, prediction: Column | str) -> Column:
    """High / Medium / Low from the probability; without one, from the class."""
    prob = F.col(probability) if isinstance(probability, str) else probability
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    by_class = F.when(pred == 1, "High").otherwise("Low")
    by_prob = (F.when(prob >= HIGH_RISK_AT, "High")
               .when(prob >= MEDIUM_RISK_AT, "Medium")
               .otherwise("Low"))
    return F.when(prob.isNull(), by_class).otherwise(by_prob)
