"""Tree ensembles as expressions agree with the fitted models they come from, and with their SQL."""

import os

import duckdb
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staylens.operators.train import positive_probability
from staylens.operators.tree_expr import FOREST, Ensemble, TreeExpression, of_model, probability, probability_sql


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).select(
        "id", (F.col("id") * 37 % 101 / 101).alias("a"), (F.col("id") * 53 % 97 / 97).alias("b"), (F.col("id") % 7).cast("double").alias("c"))
    df = df.withColumn("label", ((F.col("a") > 0.4) & (F.col("b") < 0.7) | (F.col("c") == 3)).cast("double"))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


@pytest.mark.parametrize("learner", [lambda: RandomForestClassifier(numTrees=4, maxDepth=4, seed=1), lambda: GBTClassifier(maxIter=4, maxDepth=3, seed=1)])
def test_expression_equals_the_model(spark, rows, learner):
    model = learner().fit(rows)
    found = of_model(model)
    assert set(found.features()) <= {0, 1, 2} and len(found.trees) == 4
    array = vector_to_array("features")
    both = model.transform(rows).select(positive_probability().alias("m"), probability(found, lambda i: array[i]).alias("e"),
                                        "prediction")
    for r in both.collect():
        assert abs(r["m"] - r["e"]) < 1e-9
        assert r["prediction"] == float(r["e"] > 0.5) or abs(r["e"] - 0.5) < 1e-9
    assert Ensemble.from_json(found.to_json()).features() == found.features()


def test_sql_equals_the_expression(rows, workdir):
    stated = Ensemble(FOREST, [(0, 0.3, 0.25, (2, 2.0, (1, 0.5, 0.6, 0.9), 0.4)), (1, 0.2, 1.0, 0.0), 0.5], [1.0, 2.0, 0.5])
    names = ["a", "b", "c"]
    made = TreeExpression(stated, names).transform(rows).select("id", "probability", "prediction").toPandas().set_index("id")
    plain = rows.select("id", *names).toPandas()
    con = duckdb.connect()
    con.register("plain", plain)
    want = con.execute(f"SELECT id, {probability_sql(stated, lambda i: names[i])} AS p FROM plain").df().set_index("id")["p"]
    assert (made["probability"].sort_index() == want.sort_index()).all()
    assert (made["prediction"].sort_index() == (want.sort_index() > 0.5)).all()
    path = os.path.join(workdir, "pipeline")
    PipelineModel(stages=[TreeExpression(stated, names)]).write().save(path)
    again = PipelineModel.load(path).transform(rows).select("id", "probability").toPandas().set_index("id")["probability"]
    assert (again.sort_index() == made["probability"].sort_index()).all()
