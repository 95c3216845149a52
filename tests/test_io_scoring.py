"""Sources, sinks, persistence, contracts, batch and streaming scoring."""

import json
import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from staylens.operators.columns import check_schema, processed_input
from staylens.operators.preprocess import BookingPreprocessor, BookingPreprocessorModel
from staylens.operators.train import GRIDS, SearchConfig, grid_points, resolve, sample_points, search
from staylens.plans.scoring import score_frame, score_records
from staylens.plans.training import auto_select, prepare_training_data
from staylens.sources.files import (flatten_evaluation, load_pipeline, read_evaluations,
                                    read_processed, read_raw_csv, records_frame, save_model,
                                    write_evaluation, write_processed)
from staylens.sources.tables import bookings, with_signal_label
from staylens.streaming.scoring import start_scoring_stream

from conftest import SF_SMALL


def test_csv_na_tokens_and_types(spark, workdir):
    path = os.path.join(workdir, "raw.csv")
    with open(path, "w") as f:
        f.write("hotel,lead_time,children,agent,Customer Type\n")
        f.write("City Hotel,10,NA,9,Transient\n")
        f.write("NULL,n/a,2.0,,#N/A\n")
        f.write("Resort Hotel,oops,1.5,240,Group\n")
    df = read_raw_csv(spark, path)
    rows = df.collect()
    assert dict(df.dtypes)["lead_time"] == "int" and dict(df.dtypes)["agent"] == "string"
    assert rows[0]["children"] is None and rows[1]["hotel"] is None and rows[1]["agent"] is None
    assert rows[1]["Customer Type"] is None and rows[2]["lead_time"] is None
    with pytest.raises(FileNotFoundError):
        read_raw_csv(spark, os.path.join(workdir, "missing.csv"))


def test_processed_label_last_roundtrip(spark, workdir):
    df = spark.createDataFrame([(1, 0.5, 2.0)], "is_canceled int, a double, b double")
    write_processed(df, os.path.join(workdir, "p"), "is_canceled")
    back, feats = read_processed(spark, os.path.join(workdir, "p"), "is_canceled")
    assert back.columns[-1] == "is_canceled" and feats == ["a", "b"]
    with pytest.raises(KeyError):
        read_processed(spark, os.path.join(workdir, "p"), "label")


def test_evaluation_record_roundtrip_and_flatten(spark, workdir):
    rec = {"model_name": "m", "best_cv_score": 0.9, "accuracy": 0.8,
           "report": {"0": {"precision": 1.0, "recall": 0.5, "f1_score": 0.6, "support": 4}},
           "confusion_matrix": [[2, 2], [0, 4]], "auc": 0.75, "roc_path": "x"}
    write_evaluation(spark, rec, os.path.join(workdir, "evaluations", "m"))
    ev = read_evaluations(spark, os.path.join(workdir, "evaluations", "*"))
    assert ev.first()["confusion_matrix"] == [[2, 2], [0, 4]]
    flat = {(r["key"], r["sub_key"]): r["value"] for r in flatten_evaluation(ev).collect()}
    assert flat[("confusion_matrix", None)] == "List with 2 items"
    assert json.loads(flat[("report", "0")])["support"] == 4
    assert read_evaluations(spark, os.path.join(workdir, "none", "*")).count() == 0


def test_preprocessor_save_load_and_contracts(spark, workdir):
    raw = bookings(spark, SF_SMALL)
    model = BookingPreprocessor(labelCol="is_canceled", passthroughCols=["booking_id"]).fit(raw)
    save_model(model, os.path.join(workdir, "prep"))
    again = BookingPreprocessorModel.load(os.path.join(workdir, "prep"))
    a = model.transform(raw).orderBy("booking_id").collect()
    b = again.transform(raw).orderBy("booking_id").collect()
    assert a == b
    assert "assigned_room_type" in model.required_raw_columns
    assert "agent" not in model.required_raw_columns
    with pytest.raises(ValueError, match="columns not given"):
        check_schema(raw.drop("hotel"), model.required_raw_columns)
    with pytest.raises(ValueError, match="not numbers"):
        processed_input(raw, model.feature_columns)
    with pytest.raises(ValueError):
        save_model(None, os.path.join(workdir, "none"))
    with pytest.raises(ValueError):
        records_frame(spark, [])


def test_unknown_model_name():
    with pytest.raises(ValueError):
        resolve("Perceptron")
    assert resolve("RandomForest") == "random_forest"
    pts = sample_points(GRIDS["random_forest"], 10, 42)
    assert len({json.dumps(p, sort_keys=True) for p in grid_points(GRIDS["random_forest"])}) == 36
    assert len(pts) == 10 and len({json.dumps(p, sort_keys=True) for p in pts}) == 10


# Tests only: grids of the same shape with small forests and few rounds.
SMALL = {"random_forest": {"numTrees": [5, 10], "maxDepth": [5], "minInstancesPerNode": [1, 3], "bootstrap": [True]},
         "boost_symmetric": {"maxDepth": [4], "stepSize": [0.1, 0.3], "maxIter": [5]}}


@pytest.fixture(scope="module")
def trained(spark):
    raw = with_signal_label(bookings(spark, SF_SMALL)).drop("is_canceled")
    data = prepare_training_data(spark, raw, "label_signal", "booking_id", folds=3)
    cfg = SearchConfig(n_iter=2, folds=3, grids=SMALL, parallelism=2)
    summary, best, pipeline = auto_select(spark, data, cfg, names=("random_forest", "boost_symmetric"))
    return data, summary, best, pipeline


def test_selection_and_quality(trained):
    data, summary, best, pipeline = trained
    rows = summary.collect()
    assert [r["Model"] for r in rows][0] == best
    assert rows[0]["Best_CV_Score"] >= rows[-1]["Best_CV_Score"]
    # label has signal: better than the majority class
    majority = max(data.test.groupBy("label").count().collect(), key=lambda r: r["count"])["count"]
    assert rows[0]["Accuracy"] > majority / data.test.count()


def test_saved_pipeline_scores_equal(trained, spark):
    data, _, _, pipeline = trained
    loaded = load_pipeline(os.path.join(data.base, "best_model"))
    split = spark.read.parquet(os.path.join(data.base, "split"))
    test_raw = split.where(F.col("part") == "test").drop("part", "fold", "label_signal")
    a = score_records(pipeline, test_raw, keep=["booking_id"]).orderBy("booking_id").collect()
    b = score_records(loaded, test_raw, keep=["booking_id"]).orderBy("booking_id").collect()
    assert a == b and len(a) == test_raw.count()
    for r in a:
        assert r["label"] == ("Canceled" if r["prediction"] == 1 else "Not canceled")
        assert r["risk_level"] == ("High" if r["probability"] >= 0.7 else
                                   "Medium" if r["probability"] >= 0.4 else "Low")


def test_processed_scoring_path(trained, spark):
    data, _, _, pipeline = trained
    prep = next(s for s in pipeline.stages if isinstance(s, BookingPreprocessorModel))
    feats = prep.transform(bookings(spark, SF_SMALL)).select("booking_id", *[
        F.col(f"`{c}`") for c in prep.feature_columns])
    out = score_frame(pipeline, feats, processed=True, keep=["booking_id"])
    assert out.count() == feats.count()
    with pytest.raises(ValueError, match="columns not given"):
        score_frame(pipeline, feats.drop(prep.feature_columns[0]), processed=True)


def test_streaming_scoring(trained, spark, workdir):
    data, _, _, pipeline = trained
    split = spark.read.parquet(os.path.join(data.base, "split"))
    test_raw = split.where(F.col("part") == "test").drop("part", "fold", "label_signal")
    src = os.path.join(workdir, "incoming")
    test_raw.repartition(3).write.json(src)
    q = start_scoring_stream(spark, pipeline, src, test_raw.schema, os.path.join(workdir, "scored"),
                             os.path.join(workdir, "ckpt"))
    q.awaitTermination(300)
    out = spark.read.parquet(os.path.join(workdir, "scored"))
    assert out.count() == test_raw.count()
    assert set(out.columns) == {"booking_id", "prediction", "label", "probability", "risk_level"}


def test_fold_parallel_search_equals_cross_validator(trained):
    data = trained[0]
    cfg = SearchConfig(n_iter=2, folds=3, grids=SMALL, parallelism=3)
    cv_cfg = SearchConfig(n_iter=2, folds=3, grids=SMALL, parallelism=3, engine="cross_validator")
    _, s1, p1 = search("random_forest", data.train, cfg)
    _, s2, p2 = search("random_forest", data.train, cv_cfg)
    assert p1 == p2 and abs(s1 - s2) < 1e-12
