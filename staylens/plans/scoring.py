"""Batch scoring: records -> validated features -> prediction, label, probability, risk.

A saved pipeline holds all that scoring needs: the raw contract, the fitted
preprocessor with its category dictionary, and the model.  One job without a
shuffle of the records, unless a dictionary is too large to broadcast.  Works
on batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label_text, risk_level
from ..functions.names import clean_columns, clean_name, qcol
from ..operators.columns import RawContract, processed_input
from ..operators.preprocess import BookingPreprocessorModel, FeatureVector
from ..operators.train import positive_probability
from ..operators.tree_expr import TreeExpression


def scoring_pipeline(preprocessor, model) -> PipelineModel:
    """The scoring artefact: raw contract, preprocessor, model (an assembler alone takes processed records only)."""
    if model is None:
        raise ValueError("there is no fitted model to score with")
    stages = [preprocessor]
    if isinstance(preprocessor, BookingPreprocessorModel):
        stages = [preprocessor.contract(), preprocessor]
    return PipelineModel(stages=[*stages, model])


def _stage(pipeline: PipelineModel, kind):
    return next((s for s in pipeline.stages if isinstance(s, kind)), None)


def expected_features(pipeline: PipelineModel) -> list[str]:
    """Model features: from the fitted preprocessor, else from the assembler stage."""
    prep = _stage(pipeline, BookingPreprocessorModel)
    if prep is not None:
        return prep.feature_columns
    asm = _stage(pipeline, (FeatureVector, VectorAssembler))
    return list(asm.getInputCols()) if asm is not None else []


def _raw_features(pipeline: PipelineModel, prep: BookingPreprocessorModel, records: DataFrame,
                  keep: list[str]) -> DataFrame:
    """Features of raw records; kept columns ride along as ``staylens_kept_<i>``, also where they are features too."""
    contract = _stage(pipeline, RawContract) or prep.contract()
    checked = contract.transform(records)
    names = [f"staylens_kept_{i}" for i in range(len(keep))]
    checked = checked.withColumns({n: qcol(k) for n, k in zip(names, keep)})
    carry = [*prep.getOrDefault(prep.passthroughCols), *names]
    return prep.copy({prep.passthroughCols: carry}).transform(checked)


def score_frame(pipeline: PipelineModel, records: DataFrame, processed: bool = False,
                keep: Sequence[str] = ()) -> DataFrame:
    """One output row per input row: kept columns, prediction, label, probability, risk_level.

    Raw records must carry the raw columns seen at fit time (checked from the
    schema before any job) and take the types of that time; processed records
    must be numeric and carry every model feature.
    """
    if pipeline is None or not pipeline.stages:
        raise ValueError("there is no fitted pipeline to score with")
    prep, clf = _stage(pipeline, BookingPreprocessorModel), pipeline.stages[-1]
    if prep is not None and not processed:
        kept = [clean_name(k) for k in keep if clean_name(k) in clean_columns(records).columns]
        feats = _raw_features(pipeline, prep, records, kept)
        carried = [F.col(f"staylens_kept_{i}").alias(k) for i, k in enumerate(kept)]
        names = prep.feature_columns if prep.wide else []
    else:
        kept = [k for k in keep if k in records.columns]
        if prep is not None and not prep.wide:
            raise ValueError("processed records of this model are vectors; score them with its last stage")
        names = expected_features(pipeline)
        feats = processed_input(records, names or None, keep=kept)
        names = names or [c for c in feats.columns if c not in kept]
        carried = [qcol(k) for k in kept]
    if "features" not in feats.columns and not isinstance(clf, TreeExpression):
        feats = FeatureVector(names, "features").transform(feats)
    out = clf.transform(feats)
    if "probability" not in out.columns:
        prob = F.lit(None).cast("double")
    else:
        plain = dict(out.dtypes)["probability"] == "double"
        prob = F.col("probability") if plain else positive_probability()
    pred = F.col("prediction").cast("int")
    return out.select(*carried, pred.alias("prediction"),
                      label_text(pred).alias("label"), prob.alias("probability"),
                      risk_level(prob, pred).alias("risk_level"))


def score_records(pipeline: PipelineModel, records: DataFrame, processed: bool = False,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Batch entry: an empty batch is an error (checked with a one-row probe)."""
    if records.isEmpty():
        raise ValueError("no records to score")
    return score_frame(pipeline, records, processed, keep)
