"""Order statistics, prefix ranks and the stratified split, with a hot key holding a third of all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from staylens.operators.ranks import exact_quantiles, running_sums
from staylens.operators.split import assign_split


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    key = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 40, n))  # key 0 holds a third
    val = np.round(rng.gamma(2.0, 50.0, n), 2)
    val[::97] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "v": val, "y": rng.integers(0, 2, n)})
    return spark.createDataFrame(pdf), pdf


def check_quantiles(df, pdf, col, probs, by):
    got = exact_quantiles(df, [col], probs, by=by).toPandas()
    groups = pdf.groupby(by[0], dropna=False) if by else [(None, pdf)]
    for k, grp in groups:
        own = got if not by else got[got[by[0]].isna()] if pd.isna(k) else got[got[by[0]] == k]
        for p in probs:
            want = grp[col].quantile(p)
            have = own[own.prob == p]["value"]
            if np.isnan(want):
                assert have.empty
            else:
                assert len(have) == 1 and np.isclose(have.iloc[0], want, rtol=1e-12, atol=1e-9), (k, p, have, want)


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_quantiles_match_pandas(skewed):
    check_quantiles(*skewed, "v", PROBS, ["k"])
    check_quantiles(*skewed, "v", PROBS, [])


def test_quantiles_of_any_distribution_and_type(spark):
    rng = np.random.default_rng(3)
    n = 20_000
    massed = np.where(rng.random(n) < 0.4, 0.0, rng.normal(0, 1e-6, n))
    massed[:3] = [1e9, -1e18, 1e18]
    pdf = pd.DataFrame({"massed": massed, "id": np.arange(n) * 7919 + (1 << 52), "flag": rng.integers(0, 2, n),
                        "k": np.where(np.arange(n) % 3 == 0, None, "key")})
    pdf["small"] = (pdf["id"] % 300).astype("int32")
    df = spark.createDataFrame(pdf, "massed double, id long, flag long, k string, small int")
    for col in ("massed", "id", "small", "flag"):
        check_quantiles(df, pdf, col, PROBS, ["k"])        # a null key is a key of its own
    assert exact_quantiles(df.withColumn("b", F.col("flag") == 1), ["b"], [0.5]).first()["value"] == pdf["flag"].quantile(0.5)


def test_quantiles_of_infinities_nulls_and_nothing(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x, None) for x in (-inf, 1.0, 2.0, inf, inf, None, float("nan"))], "x double, y double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x", "y"], [0.0, 0.25, 0.5, 1.0]).collect()}
    assert got == {0.0: -inf, 0.25: 1.0, 0.5: 2.0, 1.0: inf}
    assert exact_quantiles(df.where("y > 0"), ["x"], [0.5]).count() == 0


def test_more_rounds_find_the_same(skewed):
    from staylens.operators.ranks import long_values, narrow, quantiles
    df, pdf = skewed
    long = long_values(narrow(df, ["v"], ["k"]), ["v"], ["k"])
    once, often = ({tuple(r)[:3]: r["value"] for r in quantiles(long, ["k", "column"], PROBS, rows).collect()}
                   for rows in (3000, 10 ** 13))
    assert once == often and len(once) == pdf["k"].nunique() * len(PROBS)


@pytest.mark.parametrize("ranges", [None, 1, 7])
def test_running_sums(skewed, ranges):
    df, pdf = skewed
    per = df.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("k", "v").agg(
        F.count(F.lit(1)).alias("c"))
    got = running_sums(per, ["k"], "v", ["c"], descending=True, with_next=True, ranges=ranges).toPandas()
    ref = per.toPandas().sort_values(["k", "v"], ascending=[True, False])
    ref["before"] = ref.groupby("k")["c"].cumsum() - ref["c"]
    ref["next"] = ref.groupby("k")["c"].shift(-1)
    ref["total"] = ref.groupby("k")["c"].transform("sum")
    m = got.merge(ref, on=["k", "v"])
    assert len(m) == len(ref)
    assert (m["c_before"] == m["before"]).all() and (m["c_total"] == m["total"]).all()
    assert ((m["c_next"] == m["next"]) | (m["c_next"].isna() & m["next"].isna())).all()


def test_massed_scores_are_spread_over_ranges(spark):
    """Nearly all distinct scores lie within 1e-9 of 0 and 1, yet no range holds many of them."""
    scores = spark.range(40_000).select((F.col("id") % 2 + F.col("id") * 1e-14).alias("s"), F.lit(1).alias("c"))
    running_sums(scores, [], "s", ["c"], ranges=16)
    from staylens.session import shared_dir
    import glob
    newest = max(glob.glob(f"{shared_dir(spark)}/ranges-*"), key=lambda p: int(__import__("os").stat(p).st_mtime_ns))
    sizes = [r["count"] for r in spark.read.parquet(newest).groupBy("_range").count().collect()]
    assert len(sizes) >= 14 and max(sizes) < 3 * 40_000 / 16


def test_split_is_stratified_stable_and_partition_free(skewed, spark):
    df, pdf = skewed
    base = df.select("id", "y", "k")
    a = assign_split(base, "y", 0.3, folds=5, key_cols=["id"]).toPandas().sort_values("id")
    b = assign_split(base.repartition(1), "y", 0.3, folds=5, key_cols=["id"]).toPandas().sort_values("id")
    c = assign_split(base.repartition(8, "k"), "y", 0.3, folds=5, key_cols=["id"]).toPandas().sort_values("id")
    assert (a["part"].values == b["part"].values).all() and (a["part"].values == c["part"].values).all()
    assert a["fold"].equals(b["fold"])
    for y, grp in a.groupby("y"):
        n_test = (grp["part"] == "test").sum()
        assert abs(n_test - 0.3 * len(grp)) <= 1
        folds = grp[grp["part"] == "train"]["fold"]
        assert set(folds) == set(range(5))
        sizes = folds.value_counts()
        assert sizes.max() - sizes.min() <= 1
    assert a[a["part"] == "test"]["fold"].isna().all()


def test_profiles_do_not_depend_on_partitioning(spark):
    from staylens.operators import distribution as D
    from staylens.operators import profile as P
    from staylens.plans.frames import profile_frame
    from conftest import SF_SMALL
    base = profile_frame(spark, SF_SMALL).cache()

    def run(df):
        return {
            "describe": sorted(P.numeric_describe(df, ["lead_time", "adr"]).collect()),
            "cat": sorted(P.categorical_describe(df, ["hotel", "country"]).collect()),
            "box": sorted(D.box_stats(df, ["lead_time", "adr"], ["is_canceled"]).collect()),
            "hist": sorted(D.histogram(df, ["adr"]).collect()),
        }

    one, many = run(base.repartition(1)), run(base.repartition(8, "booking_id"))
    for k in one:
        assert len(one[k]) == len(many[k])
        for a, b in zip(one[k], many[k]):
            for x, y in zip(a, b):
                assert (x == y) or (isinstance(x, float) and abs(x - y) < 1e-9), (k, a, b)


def test_equal_rows_are_split_by_count(spark):
    """A row repeated 100,000 times is dealt to the parts in proportion, and so are different rows with one key."""
    many = spark.range(100_000).select(F.lit("same").alias("k"), F.lit(1.5).alias("x"), F.lit(1).alias("y"))
    keyed = spark.range(999).select(F.lit("one key").alias("k"), F.col("id").cast("double").alias("x"), F.lit(0).alias("y"))
    alone = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit(None).cast("double").alias("x"),
                                    F.lit(None).cast("int").alias("y"))
    df = many.unionByName(keyed).unionByName(alone)
    out = assign_split(df, "y", 0.3, folds=5, key_cols=["k"])
    assert out.columns == ["k", "x", "y", "part", "fold"]
    for y, n in ((1, 100_000), (0, 999), (None, 500)):
        own = out.where(F.col("y").eqNullSafe(F.lit(y)))
        sizes = {(r["part"], r["fold"]): r["count"] for r in own.groupBy("part", "fold").count().collect()}
        assert sum(sizes.values()) == n and abs(sizes["test", None] - 0.3 * n) <= 1
        folds = [v for k, v in sizes.items() if k[0] == "train"]
        assert len(folds) == 5 and max(folds) - min(folds) <= 1
    assert out.where("k = 'one key'").select("x").distinct().count() == 999
    again = assign_split(df.repartition(3), "y", 0.3, folds=5, key_cols=["k"])
    assert again.where("k = 'one key'").exceptAll(out.where("k = 'one key'")).isEmpty()


def test_split_of_little(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(5)], "id int, y int")
    assert assign_split(df, "y", 1.0).where("part = 'test'").count() == 5
    assert assign_split(df, "y", 0.0, folds=3).where("part = 'train'").count() == 5
    assert assign_split(df.where("id < 0"), "y", 0.3, folds=3).count() == 0


def test_split_moves_no_rows(spark):
    """Rows with a wide column meet no exchange: only label and hash are read for the cuts."""
    wide = spark.range(1000).select("id", (F.col("id") % 2).alias("y"), F.repeat(F.lit("x"), 100).alias("wide"))
    plan = assign_split(wide, "y", 0.3, key_cols=["id"])._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert not exchanges, plan
