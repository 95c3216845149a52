"""Fit / transform queries: imputation, one-hot, scaling and the composite preprocessor.

Transforms are compared in long form (booking_id, feature, value): the
one-hot column set comes from the data, the long form states it in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import categorical_columns, numeric_columns
from ..operators.columns import prepare_raw
from ..operators.encode import category_counts, fit_dictionary, indicators, with_slots
from ..operators.impute import apply_imputer, categorical_fill_values, fit_imputer, numeric_fill_values
from ..operators.preprocess import BookingPreprocessor, BookingPreprocessorModel
from ..operators.split import assign_split
from ..sources.tables import bookings
from ..session import shared_dir, stored
from .catalog import r6, r6_double, register
from .oracle import PREPARED_CTE, PREPARED_NUMERIC, PREPARED_TEXT, split_ctes, union_all, with_ctes
from ..functions.names import qcol

ID, LABEL = "booking_id", "is_canceled"


def prepared_features(spark, sf_dir) -> DataFrame:
    return prepare_raw(bookings(spark, sf_dir))


def stored_features(spark, sf_dir) -> DataFrame:
    """The same, written once: a fit and a transform both read them instead of deriving them again."""
    return stored(prepared_features(spark, sf_dir), "bookings")


def _features_only(df: DataFrame) -> DataFrame:
    return df.drop(ID, LABEL)


# ---------------------------------------------------------------- imputation
@register("impute_numeric_values", with_ctes(union_all([
    f"""SELECT '{c}' AS "column", round(coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0.0), 6) AS value
FROM prepared""" for c in PREPARED_NUMERIC]), PREPARED_CTE))
def impute_numeric_values(spark, sf_dir):
    feats = _features_only(prepared_features(spark, sf_dir))
    vals = numeric_fill_values(feats, numeric_columns(feats), "median")
    return vals.select("column", r6("value").alias("value"))


def _mode_sql(c: str, source: str) -> str:
    return (f"coalesce((SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1), 'Unknown')")


@register("impute_text_values", with_ctes(union_all([
    f"""SELECT '{c}' AS "column", {_mode_sql(c, 'prepared')} AS value""" for c in PREPARED_TEXT]),
    PREPARED_CTE))
def impute_text_values(spark, sf_dir):
    feats = _features_only(prepared_features(spark, sf_dir))
    return categorical_fill_values(feats, categorical_columns(feats), "mode").select("column", "value")


FILLS_CTE = ("\nfills AS (SELECT " + ", ".join(
    [f"coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0.0) AS {c}" for c in PREPARED_NUMERIC]
    + [f"{_mode_sql(c, 'prepared')} AS {c}" for c in PREPARED_TEXT]) + " FROM prepared)")


@register("impute_transform", with_ctes(
    "SELECT p.booking_id, p.is_canceled, " + ", ".join(
        [f"round(coalesce(CAST(p.{c} AS DOUBLE), f.{c}), 6) AS {c}" for c in PREPARED_NUMERIC]
        + [f"coalesce(p.{c}, f.{c}) AS {c}" for c in PREPARED_TEXT])
    + " FROM prepared p, fills f", PREPARED_CTE, FILLS_CTE))
def impute_transform(spark, sf_dir):
    prepared = prepared_features(spark, sf_dir)
    values = fit_imputer(_features_only(prepared))
    out = apply_imputer(prepared, values)
    nums = numeric_columns(_features_only(prepared))
    return out.select(ID, LABEL, *[r6(c).alias(c) for c in nums],
                      *categorical_columns(_features_only(prepared)))


# ---------------------------------------------------------------- one-hot
_CAT_LONG = ("\ncat_long AS (SELECT booking_id, col, cat FROM (UNPIVOT (SELECT p.booking_id, "
             + ", ".join(f"coalesce(p.{c}, f.{c}) AS {c}" for c in PREPARED_TEXT)
             + " FROM prepared p, fills f) ON " + ", ".join(PREPARED_TEXT)
             + " INTO NAME col VALUE cat))")
_CATS = "\ncats AS (SELECT DISTINCT col, cat FROM cat_long)"


@register("onehot_categories", with_ctes(
    "SELECT col AS \"column\", cat AS category, col || '_' || cat AS feature, count(*) AS n "
    "FROM cat_long GROUP BY col, cat", PREPARED_CTE, FILLS_CTE, _CAT_LONG))
def onehot_categories(spark, sf_dir):
    prepared = _features_only(prepared_features(spark, sf_dir))
    cats = categorical_columns(prepared)
    filled = apply_imputer(prepared, fit_imputer(prepared))
    counts = category_counts(filled, cats)
    return counts.select("column", F.col("value").alias("category"),
                         F.concat_ws("_", "column", "value").alias("feature"),
                         F.col("cnt").alias("n"))


@register("onehot_transform", with_ctes(
    "SELECT t.booking_id, c.col || '_' || c.cat AS feature, "
    "CASE WHEN t.cat = c.cat THEN 1.0 ELSE 0.0 END AS value "
    "FROM cat_long t JOIN cats c ON t.col = c.col", PREPARED_CTE, FILLS_CTE, _CAT_LONG, _CATS))
def onehot_transform(spark, sf_dir):
    """Indicator columns only (before scaling), from the fitted fills and the dictionary."""
    prepared = prepared_features(spark, sf_dir)
    feats = _features_only(prepared)
    fitted = fit_dictionary(feats, categorical_columns(feats))
    names = {c: [] for c in fitted.columns}
    for r in fitted.table.orderBy("pos", "slot").collect():
        names[r["column"]].append(r["category"])
    cols = indicators(fitted, names)
    wide = with_slots(prepared, fitted, prepared.count()).select(ID, *[v.alias(c) for c, v in cols.items()])
    return wide.unpivot([ID], [qcol(c) for c in cols], "feature", "value")


#: A text column of 5,000 codes, none of them frequent; every third booking is not seen in training.
CODES = 5000
_CODED = f"""
coded AS (SELECT booking_id, is_canceled, lead_time, hotel, market_segment,
  'G' || CAST(booking_id * 7919 % {CODES} AS VARCHAR) AS guest_code FROM prepared),
fitted AS (SELECT * FROM coded WHERE booking_id % 3 <> 0),
fillc AS (SELECT coalesce(quantile_cont(CAST(lead_time AS DOUBLE), 0.5), 0.0) AS lead_time, {_mode_sql('hotel', 'fitted')} AS hotel,
  {_mode_sql('market_segment', 'fitted')} AS market_segment FROM fitted),
dict_rows AS (SELECT 0 AS pos, 'hotel' AS col, coalesce(r.hotel, f.hotel) AS cat FROM fitted r, fillc f
  UNION ALL SELECT 1, 'market_segment', coalesce(r.market_segment, f.market_segment) FROM fitted r, fillc f
  UNION ALL SELECT 2, 'guest_code', guest_code FROM fitted),
dict AS (SELECT *, row_number() OVER (ORDER BY pos, cat) AS place FROM (SELECT pos, col, cat, count(*) AS n FROM dict_rows GROUP BY ALL))"""


def _coded(spark, sf_dir) -> tuple[DataFrame, BookingPreprocessorModel]:
    rows = prepared_features(spark, sf_dir).select(
        ID, LABEL, "lead_time", "hotel", "market_segment",
        F.concat(F.lit("G"), (F.col(ID) * 7919 % CODES).cast("string")).alias("guest_code"))
    prep = BookingPreprocessor(labelCol=LABEL, passthroughCols=[ID])
    return rows, prep.fit(rows.where(F.col(ID) % 3 != 0))


@register("dictionary_categories", with_ctes("""
SELECT 0 AS "index", 'lead_time' AS feature, CAST(NULL AS BIGINT) AS n
UNION ALL SELECT CAST(place AS INT), col || '_' || cat, n FROM dict""", PREPARED_CTE, _CODED))
def dictionary_categories(spark, sf_dir):
    """The features of a model with thousands of categories: vector index, name, training rows."""
    model = _coded(spark, sf_dir)[1]
    counts = model.dictionary_table.select(F.concat_ws("_", "column", "category").alias("feature"), "n")
    return model.feature_table().join(counts, "feature", "left").select("index", "feature", "n")


@register("dictionary_transform", with_ctes("""
SELECT booking_id, is_canceled, 0 AS "index", round((coalesce(CAST(c.lead_time AS DOUBLE), f.lead_time) - mn) / (mx - mn), 6) AS value
FROM coded c, fillc f, (SELECT least(min(r.lead_time), any_value(CASE WHEN q.k < q.n THEN f.lead_time END)) AS mn,
    greatest(max(r.lead_time), any_value(CASE WHEN q.k < q.n THEN f.lead_time END)) AS mx
  FROM fitted r, fillc f, (SELECT count(lead_time) AS k, count(*) AS n FROM fitted) q) s
WHERE coalesce(CAST(c.lead_time AS DOUBLE), f.lead_time) <> mn
UNION ALL SELECT booking_id, is_canceled, CAST(place AS INT), 1.0 FROM coded c, fillc f, dict d
WHERE (d.pos = 0 AND d.cat = coalesce(c.hotel, f.hotel)) OR (d.pos = 1 AND d.cat = coalesce(c.market_segment, f.market_segment))
  OR (d.pos = 2 AND d.cat = c.guest_code)""", PREPARED_CTE, _CODED))
def dictionary_transform(spark, sf_dir):
    """The entries of the sparse vectors of all bookings, seen in training or not."""
    rows, model = _coded(spark, sf_dir)
    return model.entries(rows).select(ID, LABEL, "index", r6("value").alias("value"))


# ---------------------------------------------------------------- full preprocessor
def prep_ctes(fit_source: str, apply_source: str) -> tuple[str, ...]:
    nums, cats = PREPARED_NUMERIC, PREPARED_TEXT
    fills = ("\nfit_fills AS (SELECT " + ", ".join(
        [f"coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0.0) AS {c}" for c in nums]
        + [f"{_mode_sql(c, 'fit_rows')} AS {c}" for c in cats]) + " FROM fit_rows)")

    def imp(name: str, src: str) -> str:
        return (f"\n{name} AS (SELECT r.booking_id, " + ", ".join(
            [f"coalesce(CAST(r.{c} AS DOUBLE), f.{c}) AS {c}" for c in nums]
            + [f"coalesce(r.{c}, f.{c}) AS {c}" for c in cats]) + f" FROM {src} r, fit_fills f)")

    def long(name: str, src: str) -> str:
        return (f"\n{name}_num AS (SELECT booking_id, feature, value FROM (UNPIVOT (SELECT booking_id, "
                + ", ".join(nums) + f" FROM {src}) ON " + ", ".join(nums)
                + " INTO NAME feature VALUE value)),"
                f"\n{name}_cat AS (SELECT booking_id, col, cat FROM (UNPIVOT (SELECT booking_id, "
                + ", ".join(cats) + f" FROM {src}) ON " + ", ".join(cats)
                + " INTO NAME col VALUE cat))")

    return (f"\nfit_rows AS ({fit_source})", f"\napp_rows AS ({apply_source})", fills,
            imp("fit_imp", "fit_rows"), imp("app_imp", "app_rows"),
            long("fit", "fit_imp"), long("app", "app_imp"),
            "\ncats AS (SELECT DISTINCT col, cat FROM fit_cat)",
            "\nfit_all AS (SELECT booking_id, feature, value FROM fit_num UNION ALL "
            "SELECT t.booking_id, c.col || '_' || c.cat, CASE WHEN t.cat = c.cat THEN 1.0 ELSE 0.0 END "
            "FROM fit_cat t JOIN cats c ON t.col = c.col)",
            "\napp_all AS (SELECT booking_id, feature, value FROM app_num UNION ALL "
            "SELECT t.booking_id, c.col || '_' || c.cat, CASE WHEN t.cat = c.cat THEN 1.0 ELSE 0.0 END "
            "FROM app_cat t JOIN cats c ON t.col = c.col)",
            "\nstats AS (SELECT feature, avg(value) AS mu, stddev_samp(value) AS sd, "
            "min(value) AS mn, max(value) AS mx FROM fit_all GROUP BY feature)")


def scaled_sql(method: str, digits: int | None = 6) -> str:
    if method == "standard":
        expr = "(a.value - s.mu) / CASE WHEN s.sd = 0 THEN 1.0 ELSE s.sd END"
    else:
        expr = "(a.value - s.mn) / CASE WHEN s.mx - s.mn = 0 THEN 1.0 ELSE s.mx - s.mn END"
    value = f"CAST({expr} AS DOUBLE)"
    value = value if digits is None else f"round({value}, {digits})"
    return f"SELECT a.booking_id, a.feature, {value} AS value FROM app_all a JOIN stats s ON a.feature = s.feature"


def _long(model, df: DataFrame) -> DataFrame:
    out = model.transform(df)
    feats = model.feature_columns
    return (out.unpivot([ID], [qcol(f) for f in feats], "feature", "value")
            .select(ID, "feature", r6_double(F.col("value")).alias("value")))


@register("scaler_stats", with_ctes(
    "SELECT feature, round(mu, 6) AS mean, round(sd, 6) AS std, round(mn, 6) AS \"min\", "
    "round(mx, 6) AS \"max\" FROM stats", PREPARED_CTE,
    *prep_ctes("SELECT * FROM prepared", "SELECT * FROM prepared")))
def scaler_stats_query(spark, sf_dir):
    prepared = prepared_features(spark, sf_dir)
    model = BookingPreprocessor(labelCol=LABEL, passthroughCols=[ID]).fit(prepared)
    st = model.fitted
    rows = [(f, s["mean"], s["std"], s["min"], s["max"]) for f, s in st["stats"].items()]
    df = spark.createDataFrame(rows, "feature string, mean double, std double, min double, max double")
    return df.select("feature", *[r6(c).alias(c) for c in ("mean", "std", "min", "max")])


@register("minmax_transform", with_ctes(
    scaled_sql("minmax"), PREPARED_CTE,
    *prep_ctes("SELECT * FROM prepared", "SELECT * FROM prepared")))
def minmax_transform(spark, sf_dir):
    prepared = stored_features(spark, sf_dir)
    model = BookingPreprocessor(labelCol=LABEL, passthroughCols=[ID]).fit(prepared)
    return _long(model, prepared)


@register("standard_transform", with_ctes(
    scaled_sql("standard"), PREPARED_CTE,
    *prep_ctes("SELECT * FROM prepared", "SELECT * FROM prepared")))
def standard_transform(spark, sf_dir):
    prepared = stored_features(spark, sf_dir)
    model = BookingPreprocessor(labelCol=LABEL, passthroughCols=[ID],
                                scaleMethod="standard").fit(prepared)
    return _long(model, prepared)


def _split_prepared(spark, sf_dir) -> DataFrame:
    """Tagged rows, checkpointed once to the shared folder: the fit and the
    transform both read them instead of re-deriving joins and ranks."""
    shared_dir(spark)
    return assign_split(prepared_features(spark, sf_dir), LABEL, 0.3, key_cols=[ID],
                        hash_method="md5").checkpoint(eager=True)


@register("preprocess_test_rows", with_ctes(
    scaled_sql("minmax"), PREPARED_CTE, *split_ctes("prepared", LABEL, ID),
    *prep_ctes("SELECT * FROM tagged WHERE part = 'train'",
                "SELECT * FROM tagged WHERE part = 'test'")))
def preprocess_test_rows(spark, sf_dir):
    """Fit on the train split only, transform the test split."""
    tagged = _split_prepared(spark, sf_dir)
    train = tagged.where(F.col("part") == "train").drop("part")
    test = tagged.where(F.col("part") == "test").drop("part")
    model = BookingPreprocessor(labelCol=LABEL, passthroughCols=[ID]).fit(train)
    return _long(model, test)


@register("preprocess_train_rows", with_ctes(
    scaled_sql("minmax"), PREPARED_CTE, *split_ctes("prepared", LABEL, ID),
    *prep_ctes("SELECT * FROM tagged WHERE part = 'train'",
                "SELECT * FROM tagged WHERE part = 'train'")))
def preprocess_train_rows(spark, sf_dir):
    """Fit and transform the train split (fit_transform)."""
    tagged = _split_prepared(spark, sf_dir)
    train = tagged.where(F.col("part") == "train").drop("part")
    model = BookingPreprocessor(labelCol=LABEL, passthroughCols=[ID]).fit(train)
    return _long(model, train)
