"""Tree ensembles as expressions: scored inside the projection, and as the same SQL.

An ensemble is a list of trees over numbered features.  A node is a number (a
leaf: the probability of class 1 in a forest, the tree's vote in a boosted
ensemble) or ``(feature, threshold, left, right)``; a row goes left where the
feature is not above the threshold.  :func:`probability` compiles it to a
column, :func:`probability_sql` to SQL text with the same arithmetic in the
same order, and :func:`of_model` reads the trees of a fitted
``pyspark.ml`` forest or gradient-boosted classifier.

Nested conditions grow with the nodes: meant for ensembles up to some
thousands of nodes; larger ones are scored by their own ``pyspark.ml`` model.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import qcol
from ..session import scratch_path

FOREST, BOOST = "forest", "boost"


@dataclass(frozen=True)
class Ensemble:
    """``forest``: mean of the leaves; ``boost``: logistic of twice the weighted sum of the votes."""

    kind: str
    trees: Sequence
    weights: Sequence[float]

    def to_json(self) -> str:
        return json.dumps({"kind": self.kind, "trees": self.trees, "weights": list(self.weights)})

    @staticmethod
    def from_json(text: str) -> "Ensemble":
        parts = json.loads(text)
        return Ensemble(parts["kind"], parts["trees"], parts["weights"])

    def features(self) -> list[int]:
        """The features that the trees look at."""
        found, todo = set(), list(self.trees)
        while todo:
            node = todo.pop()
            if isinstance(node, (list, tuple)):
                found.add(node[0])
                todo += node[2:]
        return sorted(found)


def _walk(node, leaf: Callable, split: Callable):
    if isinstance(node, (list, tuple)):
        feature, threshold, left, right = node
        return split(feature, float(threshold), _walk(left, leaf, split), _walk(right, leaf, split))
    return leaf(float(node))


def probability(ensemble: Ensemble, feature: Callable[[int], Column]) -> Column:
    """Probability of class 1; ``feature`` gives the column of a feature number."""
    trees = [_walk(t, F.lit, lambda f, at, left, right: F.when(feature(f) <= F.lit(at), left).otherwise(right))
             for t in ensemble.trees]
    total = F.lit(0.0)
    for tree, weight in zip(trees, ensemble.weights):
        total = total + tree * F.lit(float(weight))
    if ensemble.kind == FOREST:
        return total / F.lit(float(sum(ensemble.weights)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))


def probability_sql(ensemble: Ensemble, feature: Callable[[int], str]) -> str:
    """The same as SQL text; ``feature`` gives the SQL of a feature number."""
    def number(x: float) -> str:
        return f"CAST({x!r} AS DOUBLE)"

    trees = [_walk(t, number, lambda f, at, left, right:
                   f"CASE WHEN {feature(f)} <= {number(at)} THEN {left} ELSE {right} END") for t in ensemble.trees]
    total = number(0.0)
    for tree, weight in zip(trees, ensemble.weights):
        total = f"({total} + {tree} * {number(float(weight))})"
    if ensemble.kind == FOREST:
        return f"{total} / {number(float(sum(ensemble.weights)))}"
    return f"1.0 / (1.0 + exp(-2.0 * {total}))"


def of_model(model) -> Ensemble:
    """The trees of a fitted random forest or gradient-boosted classifier (continuous features, two classes)."""
    spark = model._java_obj and __import__("pyspark").sql.SparkSession.active()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    nodes: dict[int, dict[int, object]] = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        nodes.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    forest = not hasattr(model, "treeWeights") or type(model).__name__.startswith("RandomForest")

    def tree(own: dict, at: int):
        node = own[at]
        if node["leftChild"] < 0:
            if not forest:
                return float(node["prediction"])
            counts = list(node["impurityStats"])
            return float(counts[1] / sum(counts)) if len(counts) > 1 else 0.0
        split = node["split"]
        if split["numCategories"] >= 0:
            raise ValueError("only splits of continuous features can be written as expressions")
        return (split["featureIndex"], float(split["leftCategoriesOrThreshold"][0]),
                tree(own, node["leftChild"]), tree(own, node["rightChild"]))

    trees = [tree(nodes[k], 0) for k in sorted(nodes)]
    weights = [1.0] * len(trees) if forest else [float(w) for w in model.treeWeights]
    return Ensemble(FOREST if forest else BOOST, trees, weights)


class TreeExpression(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (of class 1, a double) and ``prediction`` by an ensemble over named feature columns."""

    ensemble = Param(Params._dummy(), "ensemble", "trees as JSON", typeConverter=TypeConverters.toString)
    inputCols = Param(Params._dummy(), "inputCols", "feature columns by number", typeConverter=TypeConverters.toListString)

    def __init__(self, ensemble: Ensemble | None = None, inputCols: Sequence[str] = ()):
        super().__init__()
        self._set(ensemble=ensemble.to_json() if ensemble else "", inputCols=list(inputCols))

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.getOrDefault(self.inputCols)
        found = probability(Ensemble.from_json(self.getOrDefault(self.ensemble)), lambda i: qcol(names[i]))
        return df.withColumn("probability", found).withColumn(
            "prediction", F.when(F.col("probability") > 0.5, F.lit(1.0)).otherwise(F.lit(0.0)))
