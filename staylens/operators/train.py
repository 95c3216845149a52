"""Tree-ensemble classifiers, randomized search over stratified folds, importances.

Four presets, each a ``pyspark.ml`` tree ensemble with a grid in its own parameters:

* ``random_forest``      RandomForestClassifier
* ``boost_symmetric``    GBTClassifier over depth, step and rounds
* ``boost_leafwise``     GBTClassifier; depths that hold a budget of 31, 63 and 127 leaves
* ``boost_depthwise``    GBTClassifier over rounds, step, depth and row subsampling

A search draws ``n_iter`` grid points without replacement (seeded), scores
each by mean accuracy over the stratified fold column and refits the best
point on all training rows.  All (point, fold) fits run concurrently from a
driver thread pool (``parallelism``); every fit is a distributed job.

``fit_rows`` bounds the labelled rows of a fit: about so many are chosen by
the hash of their features, the same ones each time.  Trees are built on the
driver and grow with their rows, so large inputs need the bound.
"""

from __future__ import annotations

import itertools
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH_CAP = 30  # deepest tree Spark grows; an unlimited depth maps here.

# Search grids of the four presets.  A minimum of 2 or 5 rows to split
# and of 1 or 2 rows in a leaf comes to a minimum of 1, 2 or 3 rows in a leaf.
GRIDS = {
    "boost_symmetric": {"maxDepth": [4, 6, 8], "stepSize": [0.01, 0.05, 0.1], "maxIter": [200, 500]},
    "boost_leafwise": {"maxDepth": [5, 6, 7], "stepSize": [0.01, 0.05, 0.1], "maxIter": [200, 500]},
    "random_forest": {"numTrees": [100, 200], "maxDepth": [DEPTH_CAP, 10, 20],
                      "minInstancesPerNode": [1, 2, 3], "bootstrap": [True, False]},
    "boost_depthwise": {"maxIter": [100, 200, 300], "stepSize": [0.01, 0.1, 0.2], "maxDepth": [3, 6, 10],
                        "subsamplingRate": [0.7, 0.8, 1.0]},
}
# Order of automatic selection (first wins ties).
MODEL_ORDER = ("boost_symmetric", "boost_leafwise", "random_forest", "boost_depthwise")
# Library-style names accepted for the presets.
ALIASES = {"CatBoost": "boost_symmetric", "LightGBM": "boost_leafwise",
           "RandomForest": "random_forest", "XGBoost": "boost_depthwise"}


def resolve(name: str) -> str:
    key = ALIASES.get(name, name)
    if key not in GRIDS:
        raise ValueError(f"no preset {name!r}; there are {', '.join(GRIDS)}")
    return key


@dataclass(frozen=True)
class SearchConfig:
    n_iter: int = 10
    folds: int = 5
    seed: int = 42
    fit_rows: int | None = None   # labelled rows of a fit at most, about; None: all
    parallelism: int = 4          # concurrent fits (each one a distributed job)
    engine: str = "fold_parallel"  # or "cross_validator" (folds one after another)
    label_col: str = "label"
    features_col: str = "features"
    fold_col: str = "fold"
    grids: dict | None = None     # other grids than GRIDS, in the same shape


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All points in a stable order (sorted parameter names, product of value lists)."""
    names = sorted(grid)
    return [dict(zip(names, vals)) for vals in itertools.product(*[grid[n] for n in names])]


def sample_points(grid: dict[str, list], n_iter: int, seed: int) -> list[dict]:
    """``n_iter`` distinct points drawn with a seeded generator (all if fewer exist)."""
    points = grid_points(grid)
    if n_iter >= len(points):
        return points
    idx = random.Random(seed).sample(range(len(points)), n_iter)
    return [points[i] for i in idx]


def build(name: str, point: dict, cfg: SearchConfig):
    """A configured estimator for one grid point of a preset."""
    # Node ids cached next to the rows: deep trees then need no re-routing of
    # every row through the whole tree at each level (checkpointed every 10).
    common = dict(labelCol=cfg.label_col, featuresCol=cfg.features_col, seed=cfg.seed,
                  cacheNodeIds=True, maxMemoryInMB=1024, checkpointInterval=10)
    if resolve(name) == "random_forest":
        return RandomForestClassifier(featureSubsetStrategy="sqrt", **common, **point)
    return GBTClassifier(**common, **point)


def bounded(train: DataFrame, cfg: SearchConfig) -> DataFrame:
    """About ``fit_rows`` rows, chosen by a hash of their features; all rows without the bound."""
    if cfg.fit_rows is None:
        return train
    total = train.count()
    if total <= cfg.fit_rows:
        return train
    place = F.pmod(F.xxhash64(vector_to_array(F.col(cfg.features_col)), F.lit(cfg.seed)), F.lit(1 << 30))
    return train.where(place < F.lit(int((1 << 30) * cfg.fit_rows / total)))


def search(name: str, train: DataFrame, cfg: SearchConfig):
    """Randomized search x fold-column CV; returns (best model refit on all rows, cv score, point).

    ``train`` carries the label, the feature vector and the fold column
    (from :func:`split.assign_split`), so folds are stratified and stable.
    Score = mean accuracy over folds; ties go to the earlier draw.

    ``fold_parallel`` submits every (point, fold) fit at once to a pool of
    ``parallelism`` driver threads; ``CrossValidator`` runs folds in turn and
    only the points of one fold concurrently.  Both give the same scores.
    """
    train = bounded(train, cfg)
    if train.storageLevel.useDisk or train.storageLevel.useMemory:
        return _searched(resolve(name), train, cfg)
    train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _searched(resolve(name), train, cfg)
    finally:
        train.unpersist()


def _searched(name: str, train: DataFrame, cfg: SearchConfig):
    points = sample_points((cfg.grids or GRIDS)[name], cfg.n_iter, cfg.seed)
    evaluator = MulticlassClassificationEvaluator(labelCol=cfg.label_col, metricName="accuracy")
    if cfg.engine == "cross_validator":
        base = build(name, points[0], cfg)
        maps = []
        for p in points:
            est = build(name, p, cfg)
            maps.append({base.getParam(k.name): v for k, v in est.extractParamMap().items()
                         if base.hasParam(k.name)})
        cv = CrossValidator(estimator=base, estimatorParamMaps=maps, evaluator=evaluator,
                            foldCol=cfg.fold_col, numFolds=cfg.folds,
                            parallelism=cfg.parallelism, seed=cfg.seed)
        cv_model = cv.fit(train)
        scores = [float(v) for v in cv_model.avgMetrics]
        best = max(range(len(scores)), key=lambda i: (scores[i], -i))
        return cv_model.bestModel, scores[best], points[best]

    fold = F.col(cfg.fold_col)

    def score(task):
        i, f = task
        model = build(name, points[i], cfg).fit(train.where(fold != f))
        return i, evaluator.evaluate(model.transform(train.where(fold == f)))

    tasks = [(i, f) for i in range(len(points)) for f in range(cfg.folds)]
    with ThreadPoolExecutor(max_workers=max(1, cfg.parallelism)) as pool:
        results = list(pool.map(score, tasks))
    scores = [sum(v for j, v in results if j == i) / cfg.folds for i in range(len(points))]
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return build(name, points[best], cfg).fit(train), float(scores[best]), points[best]


def positive_probability(prob_col: str = "probability") -> Column:
    """Probability of class 1; the only column when the model saw one class."""
    arr = vector_to_array(F.col(prob_col))
    return F.when(F.size(arr) > 1, arr[1]).otherwise(arr[0])


def importance_table(spark, model, feature_names: list[str]) -> DataFrame:
    """(feature, importance), most important first; unnamed slots are Feature_<i>.

    One value per feature (model metadata, not data rows).
    """
    vals = model.featureImportances.toArray().tolist()
    names = [feature_names[i] if i < len(feature_names) else f"Feature_{i}"
             for i in range(len(vals))]
    df = spark.createDataFrame(list(zip(names, vals)), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")
