"""End-to-end jobs on the smallest driver tables: CSV in, processed tables, profile, train, score."""

import os

import pytest
from pyspark.sql import functions as F

from staylens.operators.train import SearchConfig
from staylens.plans import jobs
from staylens.sources.tables import bookings

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw_csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "bookings.csv")
    df = bookings(spark, SF_SMALL).drop("booking_id")
    # Raw-file style: title-case headers, the date as text.
    df = df.withColumn("reservation_status_date", F.date_format("reservation_status_date", "yyyy-MM-dd"))
    df.toDF(*[c.replace("_", " ").title() for c in df.columns]).write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def processed(spark, raw_csv, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("prep"))
    return jobs.preprocess_job(spark, jobs.read_input(spark, raw_csv), out), out


def test_preprocess_job(spark, processed, raw_csv):
    paths, _ = processed
    train = spark.read.parquet(paths["train"])
    test = spark.read.parquet(paths["test"])
    assert train.columns == test.columns and train.columns[-1] == "is_canceled"
    n_raw = jobs.read_input(spark, raw_csv).distinct().count()
    assert train.count() + test.count() == n_raw
    assert abs(test.count() - 0.3 * n_raw) <= 2
    feats = [c for c in train.columns if c != "is_canceled"]
    assert all(t == "double" for c, t in train.dtypes if c in feats)
    mins = train.agg(*[F.min(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(feats)]).first()
    maxs = train.agg(*[F.max(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(feats)]).first()
    assert all(v >= 0.0 for v in mins) and all(v <= 1.0 for v in maxs)
    assert "reservation_status" not in " ".join(feats) and "is_room_changed" in feats


def test_profile_job(spark, raw_csv, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("profile"))
    paths = jobs.profile_job(spark, jobs.read_input(spark, raw_csv), out)
    assert {"column_profile", "box_stats", "histogram", "segment_rank_picks",
            "correlation_lower", "density_curve"} <= set(paths)
    shape = spark.read.parquet(paths["table_shape"]).first()
    assert shape["n_rows"] == jobs.read_input(spark, raw_csv).count()
    hist = spark.read.parquet(paths["histogram"])
    assert hist.select("column").distinct().count() == 4 and hist.count() == 4 * 30


def test_train_and_score_jobs(spark, processed):
    paths, out = processed
    models = os.path.join(out, "models")
    cfg = SearchConfig(n_iter=1, folds=2, parallelism=2, grids={"random_forest": {
        "numTrees": [5], "maxDepth": [5], "minInstancesPerNode": [1], "bootstrap": [True]}})
    summary = jobs.train_job(spark, paths["train"], paths["test"], models, model="RandomForest",
                             cfg=cfg).collect()
    assert len(summary) == 1 and summary[0]["Model"] == "random_forest"
    test = spark.read.parquet(paths["test"]).drop("is_canceled")
    scored = jobs.score_job(spark, os.path.join(models, "random_forest"), test,
                            os.path.join(out, "scored"), processed=True)
    got = spark.read.parquet(scored)
    assert got.count() == test.count()
    assert set(got.columns) == {"prediction", "label", "probability", "risk_level"}


def test_run_then_score_raw_json(spark, raw_csv, tmp_path_factory, monkeypatch):
    """The documented commands: train from a raw file, then score raw records by the saved pipeline."""
    from staylens import __main__ as cli
    from staylens.operators import train as T
    out = str(tmp_path_factory.mktemp("run"))
    small = {"random_forest": {"numTrees": [3], "maxDepth": [4], "minInstancesPerNode": [1], "bootstrap": [True]}}
    monkeypatch.setattr(T, "GRIDS", T.GRIDS | small)
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    cli.main(["run", "--input", raw_csv, "--out", out, "--model", "RandomForest", "--n-iter", "1", "--cv", "2",
              "--drop", "reservation_status", "reservation_status_date", "agent", "company", "arrival_date_year", "assigned_room_type"])
    model = os.path.join(out, "models", "random_forest")
    for table in ("accuracy_ranking", "roc_comparison", "confusion_matrices"):
        assert spark.read.option("header", True).csv(os.path.join(out, "models", "comparison", table)).count() > 0
    # Raw records as a client sends them: other header style, numbers as text, a missing value, an unseen category.
    raw = jobs.read_input(spark, raw_csv).withColumn("Record Id", F.monotonically_increasing_id()).limit(50)
    first = F.col("Record Id") == 0
    sent = (raw.withColumn("Lead Time", F.col("Lead Time").cast("string")).withColumn("Children", F.lit(2).cast("int"))
            .withColumn("Meal", F.when(first, "XX").otherwise(F.col("Meal")))
            .withColumn("Adr", F.when(first, "NA").otherwise(F.col("Adr").cast("string"))).drop("Is Canceled"))
    path = os.path.join(out, "records.json")
    sent.write.json(path)
    cli.main(["score", "--model", model, "--input", path, "--out", os.path.join(out, "scored"), "--keep", "Record Id", "Meal"])
    got = spark.read.parquet(os.path.join(out, "scored"))
    assert got.columns == ["record_id", "meal", "prediction", "label", "probability", "risk_level"]
    assert got.count() == 50 and got.where("probability IS NULL").count() == 0
    assert got.where("record_id = 0").first()["meal"] == "XX"
    with pytest.raises(ValueError, match="columns not given"):
        jobs.score_job(spark, model, sent.drop("Hotel"), os.path.join(out, "no"))
    from staylens.streaming.scoring import start_scoring_stream
    from staylens.sources.files import load_pipeline
    query = start_scoring_stream(spark, load_pipeline(model), path, spark.read.json(path).schema, os.path.join(out, "stream"),
                                 os.path.join(out, "ckpt"), keep=["Record Id"])
    query.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(out, "stream")).orderBy("record_id").collect()
    assert streamed == got.drop("meal").orderBy("record_id").collect()


def test_train_with_another_preprocessor_is_an_error(spark, processed, tmp_path_factory):
    from staylens.operators.preprocess import BookingPreprocessor
    from staylens.sources.files import save_model
    paths, _ = processed
    other = str(tmp_path_factory.mktemp("other") / "prep")
    save_model(BookingPreprocessor(labelCol="y").fit(spark.createDataFrame([(1, "a"), (2, "b")], "y int, c string")), other)
    with pytest.raises(ValueError, match="did not make"):
        jobs.train_job(spark, paths["train"], paths["test"], str(tmp_path_factory.mktemp("m")), model="RandomForest",
                       preprocessor_path=other)


def test_no_data_and_no_model_are_clear_errors(spark):
    from staylens.plans.scoring import score_frame, scoring_pipeline
    from staylens.plans.training import run_model
    with pytest.raises(ValueError, match="no training data"):
        run_model(spark, "RandomForest", None, SearchConfig())
    with pytest.raises(ValueError, match="no fitted model"):
        scoring_pipeline(None, None)
    with pytest.raises(ValueError, match="no fitted pipeline"):
        score_frame(None, spark.range(1))
