"""Density curves against a sum over every row, whatever the distribution."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from staylens.operators import distribution as D


def by_rows(values, x):
    n = len(values)
    bw = np.std(values, ddof=1) * n ** -0.2
    return np.array([np.exp(-0.5 * ((p - values) / bw) ** 2).sum() for p in x]) / (n * bw * np.sqrt(2 * np.pi))


RNG = np.random.default_rng(11)
SHAPES = {
    "normal": RNG.normal(50, 10, 3000),
    "atoms": RNG.integers(0, 5, 3000).astype(float),
    "outlier": np.append(RNG.gamma(2, 40, 2999), 1e6),
    "negative": -np.exp(RNG.normal(3, 1, 3000)),
    "far": RNG.normal(1.7e9, 5.0, 3000),
    "two": np.array([1.0, 2.0]),
}


@pytest.mark.parametrize("name", SHAPES)
def test_density_equals_the_sum_over_rows(spark, name):
    values = SHAPES[name]
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    got = D.density(df, ["v"], points=60, trim=False).orderBy("point").toPandas()
    want = by_rows(values, got["x"].to_numpy())
    assert len(got) == 60 and np.allclose(got["density"], want, rtol=1e-6, atol=1e-9 * want.max())


def test_density_by_group_on_a_fixed_grid(spark):
    a, b = SHAPES["normal"], SHAPES["outlier"]
    df = spark.createDataFrame(pd.DataFrame({"g": ["a"] * len(a) + [None] * len(b), "v": np.concatenate([a, b])}), "g string, v double")
    got = D.density_by(df, "v", ["g"], 0.0, 400.0, 50).toPandas()
    for g, values in (("a", a), (None, b)):
        own = got[got["g"].isna() if g is None else got["g"] == g].sort_values("point")
        want = by_rows(values, own["x"].to_numpy())
        assert len(own) == 50 and np.allclose(own["density"], want, rtol=1e-6, atol=1e-12)


def test_one_far_value_makes_few_cells(spark):
    """The cells follow the values there are, not the range."""
    df = spark.createDataFrame(pd.DataFrame({"v": np.append(RNG.normal(0, 1, 2000), 1e9)}))
    got = D.density_by(df, "v", [], -5.0, 5.0, 20).collect()
    assert len(got) == 20 and all(r["density"] is not None for r in got)


def test_constant_column_and_no_values(spark):
    df = spark.createDataFrame([(3.0, None)] * 5, "v double, w double")
    got = D.density(df, ["v", "w"], points=10, trim=False).collect()
    assert len(got) == 10 and all(r["density"] is None for r in got)
    assert D.density(df.where("v > 9"), ["v"], trim=False).count() == 0


def test_trim_and_histogram_keep_null_groups(spark):
    pdf = pd.DataFrame({"g": [None, "x"] * 200, "v": np.arange(400.0)})
    df = spark.createDataFrame(pdf, "g string, v double")
    box = {r["g"]: r for r in D.box_stats(df, ["v"], ["g"]).collect()}
    limit = pdf["v"].quantile(0.99)
    for g in (None, "x"):
        own = pdf[(pdf["g"].isna() if g is None else pdf["g"] == g) & (pdf["v"] < limit)]["v"]
        assert box[g]["n"] == len(own) and box[g]["median"] == own.median() and box[g]["q1"] == own.quantile(0.25)
    hist = D.histogram(df, ["v"], 10).agg(F.sum("count")).first()[0]
    assert hist == (pdf["v"] < limit).sum()
