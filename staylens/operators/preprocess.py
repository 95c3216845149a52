"""Train-fitted preprocessing as a ``pyspark.ml`` Estimator / Model.

fit (over the prepared training rows, written once as doubles and text):

1. exact medians (or means) and one aggregate of moments of the numeric columns
   follow from that table, and the moments of the filled column from those and
   the number of missing values;
2. category counts of the text columns (one unpivoted group-by) become the
   category dictionary, a table of the model (:mod:`encode`).

transform joins the rows with the dictionary, between two projections: names
cleaned, model features, drop, numbers filled and scaled; then one-hot, aligned
to the fitted feature order, with pass-through columns (id, label) kept at the
end.  (In one projection the generated code is too long to be compiled.)
Up to ``wideFeatures`` features there is a column for each of them; beyond
that the result is a sparse vector column, and there is no upper limit.

Fitted state is one value per column, in a JSON param; the dictionary is saved
and loaded with the model as a table.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import categorical_columns, nan_to_null, numeric_columns
from ..functions.names import clean_name, clean_columns, qcol
from .columns import RawContract, check_schema, prepare_raw, raw_inputs
from .encode import Dictionary, fit_dictionary, indicators, onehot_name, with_slots
from .impute import fills_of
from .scale import filled_stats, indicator_stats, scaled, scaler_stats
from ..session import stored

#: Features up to which the result has a column for each.
WIDE_FEATURES = 1000


class FeatureVector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Columns -> one ML vector, for any column names.

    ``VectorAssembler`` parses its input names, so a one-hot name that
    carries raw category text (dots, backticks) breaks it; the columns are
    assembled under positional aliases instead and the names stay as they are.
    """

    inputCols = Param(Params._dummy(), "inputCols", "feature columns, in vector order",
                      typeConverter=TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column",
                      typeConverter=TypeConverters.toString)

    def __init__(self, inputCols=None, outputCol="features"):
        super().__init__()
        self._setDefault(inputCols=[], outputCol="features")
        self._set(inputCols=list(inputCols or []), outputCol=outputCol)

    def getInputCols(self) -> list[str]:
        return list(self.getOrDefault(self.inputCols))

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.getInputCols()
        out = self.getOrDefault(self.outputCol)
        tmp = [f"_fv{i}" for i in range(len(cols))]
        wide = df.select("*", *[qcol(c).alias(t) for c, t in zip(cols, tmp)])
        vec = VectorAssembler(inputCols=tmp, outputCol=out).transform(wide)
        return vec.drop(*tmp)


class _PrepParams(Params):
    labelCol = Param(Params._dummy(), "labelCol", "label column, passed through unchanged",
                     typeConverter=TypeConverters.toString)
    passthroughCols = Param(Params._dummy(), "passthroughCols",
                            "columns carried unchanged (ids); never features",
                            typeConverter=TypeConverters.toListString)
    scaleMethod = Param(Params._dummy(), "scaleMethod", "minmax or standard",
                        typeConverter=TypeConverters.toString)
    numStrategy = Param(Params._dummy(), "numStrategy", "median, mean or other (0)",
                        typeConverter=TypeConverters.toString)
    catStrategy = Param(Params._dummy(), "catStrategy", "mode or other ('Unknown')",
                        typeConverter=TypeConverters.toString)
    dropColumns = Param(Params._dummy(), "dropColumns", "unusable columns; empty = defaults",
                        typeConverter=TypeConverters.toListString)
    homeCountry = Param(Params._dummy(), "homeCountry", "country code of is_domestic",
                        typeConverter=TypeConverters.toString)
    wideFeatures = Param(Params._dummy(), "wideFeatures", "features up to which each has a column of its own",
                         typeConverter=TypeConverters.toInt)
    outputCol = Param(Params._dummy(), "outputCol", "vector column ('' = none, but 'features' beyond wideFeatures)",
                      typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="is_canceled", passthroughCols=[], scaleMethod="minmax",
                         numStrategy="median", catStrategy="mode", dropColumns=[],
                         homeCountry="PRT", wideFeatures=WIDE_FEATURES, outputCol="")

    def _keep(self, columns: Sequence[str]) -> list[str]:
        wanted = [clean_name(c) for c in self.getOrDefault(self.passthroughCols)]
        label = clean_name(self.getOrDefault(self.labelCol)) if self.getOrDefault(self.labelCol) else ""
        if label:
            wanted.append(label)
        return [c for c in wanted if c in columns]

    def _prepared(self, df: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
        cleaned = clean_columns(df)
        keep = self._keep(cleaned.columns)
        raw = [c for c in cleaned.columns if c not in keep]
        prepared = prepare_raw(cleaned.select(*[qcol(c) for c in raw]),
                               self.getOrDefault(self.dropColumns) or None,
                               home_country=self.getOrDefault(self.homeCountry))
        return prepared, raw, keep


class BookingPreprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fit imputation, the category dictionary and scaling on training rows only."""

    def __init__(self, **kwargs):
        super().__init__()
        self._set(**kwargs)

    def _fit(self, df: DataFrame) -> "BookingPreprocessorModel":
        prepared, raw, _ = self._prepared(nan_to_null(df))
        state, table = self._fit_state(prepared, raw)
        types = {clean_name(f.name): f.dataType.simpleString() for f in df.schema.fields}
        state["raw_types"] = {c: types[c] for c in state["required_raw_columns"]}
        model = BookingPreprocessorModel()
        self._copyValues(model)
        return model._with(state, table)

    def _fit_state(self, prepared: DataFrame, raw: list[str]) -> tuple[dict, DataFrame | None]:
        nums = numeric_columns(prepared)
        cats = categorical_columns(prepared)
        stats: dict[str, dict[str, float]] = {}
        fill: dict[str, object] = {}
        texts = [qcol(c).cast("string").alias(c) for c in cats]
        table = stored(prepared.select(*[qcol(c).cast("double").alias(c) for c in nums], *texts), "prepared") \
            if nums or cats else prepared
        rows = table.count()
        if nums:
            fill = fills_of(table, nums, self.getOrDefault(self.numStrategy), rows)
            stats = filled_stats(scaler_stats(table, nums), fill, rows)
        state = {"raw_columns": raw,
                 "required_raw_columns": raw_inputs(raw, self.getOrDefault(self.dropColumns) or None),
                 "numeric": nums, "categorical": cats, "stats": stats, "rows": rows, "sizes": {}, "bytes": {}}
        dictionary = fit_dictionary(table, cats, self.getOrDefault(self.catStrategy)) if cats else None
        if dictionary:
            fill = fill | dictionary.fill
            state |= {"sizes": dictionary.size, "bytes": dictionary.bytes}
        state["fill"] = fill
        state["n_features"] = len(nums) + sum(state["sizes"].values())
        state["wide"] = state["n_features"] <= self.getOrDefault(self.wideFeatures)
        if state["wide"]:       # so few that the model names them
            categories: dict[str, list[str]] = {c: [] for c in cats}
            for r in dictionary.table.orderBy("pos", "slot").collect() if dictionary else []:
                categories[r["column"]].append(r["category"])
                stats[onehot_name(r["column"], r["category"])] = indicator_stats(rows, r["n"])
            state["categories"] = categories
            state["features"] = list(nums) + [onehot_name(c, k) for c in cats for k in categories[c]]
        return state, dictionary.table if dictionary else None


class _ModelWriter(DefaultParamsWriter):
    """The params, and the dictionary as a table beside them."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        table = self.instance.dictionary_table
        if table is not None:
            table.write.parquet(os.path.join(path, "dictionary"))


class _ModelReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        if model.fitted["categorical"]:
            model._set(dictionaryPath=os.path.join(path, "dictionary"))
        return model


class BookingPreprocessorModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "fitted state (JSON)",
                  typeConverter=TypeConverters.toString)
    dictionaryPath = Param(Params._dummy(), "dictionaryPath", "table of the category dictionary ('' = none)",
                           typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(state="{}", dictionaryPath="")

    def _with(self, state: dict, table: DataFrame | None) -> "BookingPreprocessorModel":
        path = "" if table is None else os.path.dirname(table.inputFiles()[0])
        return self._set(state=json.dumps(state), dictionaryPath=path)

    def write(self):
        return _ModelWriter(self)

    @classmethod
    def read(cls):
        return _ModelReader(cls)

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    @property
    def wide(self) -> bool:
        return self.fitted["wide"]

    @property
    def dictionary_table(self) -> DataFrame | None:
        """(pos, column, category, n, slot) of all categories."""
        path = self.getOrDefault(self.dictionaryPath)
        return SparkSession.active().read.parquet(path) if path else None

    @property
    def feature_columns(self) -> list[str]:
        """Feature names in vector order; a dictionary beyond ``wideFeatures`` has them in :meth:`feature_table` only."""
        st = self.fitted
        if not st["wide"]:
            raise ValueError(f"the model has {st['n_features']} features; their names are in feature_table()")
        return list(st["features"])

    @property
    def required_raw_columns(self) -> list[str]:
        return list(self.fitted["required_raw_columns"])

    def _dictionary(self, st: dict) -> Dictionary:
        return Dictionary(self.dictionary_table, st["categorical"], st["fill"], st["sizes"], st["bytes"])

    def _offsets(self, st: dict) -> list[int]:
        """Vector index of each text column's first category."""
        at, out = len(st["numeric"]), []
        for c in st["categorical"]:
            out.append(at)
            at += st["sizes"][c]
        return out

    def feature_table(self) -> DataFrame:
        """(index, feature) of all features, as a table."""
        st = self.fitted
        spark = SparkSession.active()
        out = spark.createDataFrame(list(enumerate(st["numeric"])), "index int, feature string")
        if self.dictionary_table is not None:
            offsets = F.element_at(F.array(*[F.lit(o) for o in self._offsets(st)]), F.col("pos") + 1)
            out = out.unionByName(self.dictionary_table.select(
                (offsets + F.col("slot")).cast("int").alias("index"), F.concat_ws("_", "column", "category").alias("feature")))
        return out

    def _numbers(self, st: dict, columns: Sequence[str]) -> list[Column]:
        """Filled and scaled numeric features."""
        method = self.getOrDefault(self.scaleMethod)
        out = []
        for c in st["numeric"]:
            value = F.lit(0.0)
            if c in columns:
                source = qcol(c).cast("double")
                value = F.coalesce(F.when(~F.isnan(source), source), F.lit(float(st["fill"][c])))
            out.append(scaled(value, st["stats"][c], method))
        return out

    def _flags(self, st: dict, method: str) -> Column:
        """The scaled indicators of all text columns as one array, without an expression for each."""
        def own(i: int, c: str) -> Column:
            stats = [st["stats"][onehot_name(c, k)] for k in st["categories"][c]]
            on, off = (F.array(*[scaled(F.lit(x), s, method) for s in stats]) for x in (1.0, 0.0))
            return F.transform(off, lambda x, j: F.when(F.col(f"_slot{i}") == j, F.get(on, j)).otherwise(x))

        return F.concat(*[own(i, c) for i, c in enumerate(st["categorical"]) if st["categories"][c]])

    def _ready(self, df: DataFrame) -> tuple[dict, DataFrame, list[str]]:
        """State, prepared rows with ``_number<i>``, their vector ``_numbers`` and the category numbers; kept columns."""
        st = self.fitted
        cleaned = clean_columns(nan_to_null(df))
        keep = self._keep(cleaned.columns)
        # Kept columns ride along; fitted names never include them.
        prepared = prepare_raw(cleaned, self.getOrDefault(self.dropColumns) or None,
                               home_country=self.getOrDefault(self.homeCountry))
        inputs = [c for c in prepared.columns if c not in keep]
        # Before the joins: one projection of these and of the indicators is too long to be compiled.
        prepared = prepared.select("*", *[v.alias(f"_number{i}") for i, v in enumerate(self._numbers(st, inputs))])
        if st["numeric"]:
            prepared = FeatureVector([f"_number{i}" for i in range(len(st["numeric"]))], "_numbers").transform(prepared)
        if st["categorical"]:
            absent = [c for c in st["categorical"] if c not in inputs]
            known = prepared.select(*[qcol(c) for c in prepared.columns if c not in absent])
            prepared = with_slots(known, self._dictionary(st), st["rows"])
        return st, prepared, keep

    def _entries(self, st: dict) -> Column:
        """The features of a row that differ from what most rows have: an array of structs (index, value), by index.

        Scaled by ``minmax`` an indicator is 0 where the row has another
        category, so only a row's own categories and its numbers other than 0
        are listed; the one category of a constant column is 0 where the row has
        it and -1 elsewhere.  Scaled by ``standard`` every feature has a base of
        its own, which the listed ones replace.
        """
        standard = self.getOrDefault(self.scaleMethod) == "standard"
        listed = [(F.lit(i), F.col(f"_number{i}")) for i in range(len(st["numeric"]))]
        for i, (c, offset) in enumerate(zip(st["categorical"], self._offsets(st))):
            slot, share = F.col(f"_slot{i}"), F.col(f"_n{i}") / F.lit(float(st["rows"]))
            if st["sizes"][c] == 1:
                listed.append((F.lit(offset), F.when(slot.isNull(), -1.0).otherwise(0.0)))
            elif standard:
                std = F.sqrt(share * (1 - share) * (st["rows"] / max(st["rows"] - 1, 1)))
                listed.append((slot + offset, (1 - share) / std))
            else:
                listed.append((slot + offset, F.when(slot.isNotNull(), 1.0)))
        entries = F.array(*[F.struct(i.cast("int").alias("index"), v.cast("double").alias("value")) for i, v in listed])
        wanted = (lambda x: x["index"].isNotNull()) if standard else (lambda x: x["index"].isNotNull() & (x["value"] != 0))
        return F.filter(entries, wanted)

    def _base(self, st: dict) -> list[float] | None:
        """What a feature is where a row has another category, if that is not 0 (one value per feature)."""
        if self.getOrDefault(self.scaleMethod) != "standard":
            return None
        base = [0.0] * st["n_features"]
        offsets, n = self._offsets(st), st["rows"]
        for r in self.dictionary_table.toLocalIterator() if st["categorical"] else []:
            if st["sizes"][r["column"]] > 1:
                own = indicator_stats(n, r["n"])
                base[offsets[r["pos"]] + r["slot"]] = -own["mean"] / own["std"]
        return base

    def entries(self, df: DataFrame) -> DataFrame:
        """(kept columns, index, value): the entries of each row's vector, one a row, without the vector."""
        st, prepared, keep = self._ready(df)
        return (prepared.select(*[qcol(k) for k in keep], F.explode(self._entries(st)).alias("_e"))
                .select(*[qcol(k) for k in keep], "_e.index", "_e.value"))

    def _as_vector(self, st: dict, prepared: DataFrame, keep: list[str], name: str) -> DataFrame:
        size, base = st["n_features"], self._base(st)
        shared = None if base is None else prepared.sparkSession.sparkContext.broadcast(base)

        @F.udf(returnType=VectorUDT(), useArrow=False)
        def vector(index, value):
            if shared is None:
                return SparseVector(size, index, value)
            dense = list(shared.value)
            for i, v in zip(index, value):
                dense[i] = v
            return DenseVector(dense)

        listed = prepared.select(*[qcol(k) for k in keep], self._entries(st).alias("_e"))
        return listed.select(*[qcol(k) for k in keep], vector(F.col("_e.index"), F.col("_e.value")).alias(name))

    def _transform(self, df: DataFrame) -> DataFrame:
        st, prepared, keep = self._ready(df)
        vec = self.getOrDefault(self.outputCol)
        method = self.getOrDefault(self.scaleMethod)
        if not st["wide"]:
            return self._as_vector(st, prepared, keep, vec or "features")
        named = {c: F.col(f"_number{i}") for i, c in enumerate(st["numeric"])}
        flags = {}
        if st["categorical"]:
            flags = {c: scaled(v, st["stats"][c], method)
                     for c, v in indicators(self._dictionary(st), st["categories"]).items()}
        columns = [v.alias(c) for c, v in (named | flags).items()] + [qcol(k) for k in keep]
        if not vec:
            return prepared.select(*columns)
        parts = {"_numbers": F.col("_numbers")} if named else {}
        if flags:
            known = {"ml_attr": {"num_attrs": len(flags)}}
            parts["_flags"] = array_to_vector(self._flags(st, method)).alias("_flags", metadata=known)
        return FeatureVector(list(parts), vec).transform(prepared.select(*columns, *parts.values())).drop(*parts)

    def check_raw(self, df: DataFrame) -> None:
        check_schema(df, self.required_raw_columns)

    def contract(self) -> RawContract:
        """The stage before this one in a scoring pipeline."""
        return RawContract(self.fitted["raw_types"])
