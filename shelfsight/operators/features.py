"""Learned preprocessing steps as ``pyspark.ml`` stages.

Every step learns from the frame given to ``fit`` only, by aggregations; what it learned is a small
dictionary kept in a parameter, so fitted steps save and load with any ``PipelineModel``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from shelfsight.functions.numbers import clip
from shelfsight.operators import clean
from shelfsight.operators.frequent import top_values
from shelfsight.operators.profile import text_values
from shelfsight.operators.quantiles import exact_quantiles
from shelfsight.operators.value_counts import ValueCounts
from shelfsight.schemas import UNCAPPED_COLUMNS

INFREQUENT = "infrequent"


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    """Stages that persist as their parameters."""


class _Learned(Model, _Saved):
    state = Param(Params._dummy(), "state", "what fit learned, as JSON", TypeConverters.toString)

    def __init__(self, learned=None):
        super().__init__()
        if learned is not None:
            self._set(state=json.dumps(learned))

    @property
    def learned(self):
        return json.loads(self.getOrDefault(self.state))


class DropColumns(Transformer, _Saved):
    """Leaves out columns, where present."""

    columns = Param(Params._dummy(), "columns", "names to leave out", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return clean.drop_columns(df, self.getOrDefault(self.columns))


class UnknownToNull(Transformer, _Saved):
    """'unknown' in any case becomes null in the named text columns, or in all of them."""

    columns = Param(Params._dummy(), "columns", "text columns; empty means all", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._setDefault(columns=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return clean.unknown_to_null(df, self.getOrDefault(self.columns) or None)


def null_shares(df: DataFrame) -> dict[str, float]:
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    return {c: (row[c] / row["_n"] if row["_n"] else 0.0) for c in df.columns}


class DropLearned(_Learned):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.learned)


class DropSparse(Estimator, _Saved):
    """Leaves out columns whose share of nulls is above ``threshold``."""

    threshold = Param(Params._dummy(), "threshold", "largest share of nulls kept", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, threshold=0.8):
        super().__init__()
        if not 0.0 <= threshold <= 1.0:
            raise ValueError("threshold must lie in [0, 1]")
        self._set(threshold=threshold)

    def _fit(self, df: DataFrame) -> DropLearned:
        return self.learn(null_shares(df))

    def learn(self, shares: Mapping[str, float]) -> DropLearned:
        limit = self.getOrDefault(self.threshold)
        return DropLearned([c for c, share in shares.items() if share > limit])


class DropEmpty(Estimator, _Saved):
    """Leaves out columns without any value."""

    def _fit(self, df: DataFrame) -> DropLearned:
        return DropLearned([c for c, share in null_shares(df).items() if share == 1.0])


class DropConstant(Estimator, _Saved):
    """Leaves out numeric columns that never vary. One lone value says nothing and stays."""

    def _fit(self, df: DataFrame) -> DropLearned:
        names = clean.numeric_columns(df)
        if not names:
            return DropLearned([])
        # Comparing the extremes is exact where a computed deviation may not be.
        row = df.agg(
            *[F.min(c).alias(f"low_{c}") for c in names], *[F.max(c).alias(f"high_{c}") for c in names],
            *[F.count(c).alias(f"n_{c}") for c in names],
        ).first()
        return DropLearned([c for c in names if row[f"n_{c}"] > 1 and row[f"low_{c}"] == row[f"high_{c}"]])


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per text column, the smallest on ties; columns without values are absent.

    One pass, as the frame may be a long plan that should not be computed twice for two passes over it.
    """
    if not columns:
        return {}
    ranked = F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value")
    return {r["column"]: r["value"] for r in text_values(df, columns).groupBy("column").agg(ranked).collect()}


def typical_values(df: DataFrame) -> dict[str, float | str | None]:
    """The median of every numeric column and the most frequent value of every text column."""
    medians = exact_quantiles(df, clean.numeric_columns(df), [0.5])
    texts = clean.text_columns(df)
    frequent = most_frequent(df, texts)
    return {**{c: q[0] for c, q in medians.items()}, **{c: frequent.get(c, "Unknown") for c in texts}}


class ImputeModel(_Learned):
    def _transform(self, df: DataFrame) -> DataFrame:
        fills = {c: v for c, v in self.learned["fills"].items() if c in df.columns and v is not None}
        return df.withColumns({c: self._filled(df, c, v) for c, v in fills.items()})

    def _filled(self, df: DataFrame, c: str, value) -> Column:
        """Whole numbers keep their type, so that long ids stay as they are, unless the fill is no whole number."""
        if c not in self.learned["numeric"]:
            return F.coalesce(F.col(f"`{c}`"), F.lit(value).cast("string"))
        whole = isinstance(df.schema[c].dataType, IntegralType) and float(value).is_integer()
        kind = df.schema[c].dataType if whole else "double"
        return F.coalesce(F.col(f"`{c}`").cast(kind), F.lit(int(value) if whole else value).cast(kind))

    @property
    def simple_columns(self) -> list[str]:
        """Columns with few nulls."""
        return self.learned["simple"]

    @property
    def complex_columns(self) -> list[str]:
        return self.learned["complex"]


class Impute(Estimator, _Saved):
    """Median for numbers, most frequent value for text ('Unknown' if there is none), overrides first."""

    overrides = Param(Params._dummy(), "overrides", "fixed fills per column, as JSON", TypeConverters.toString)
    lowThreshold = Param(Params._dummy(), "lowThreshold", "null share up to which a column is simple", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, overrides="{}", lowThreshold=0.10):
        super().__init__()
        self._set(overrides=overrides, lowThreshold=lowThreshold)

    def _fit(self, df: DataFrame) -> ImputeModel:
        fixed = {c: v for c, v in json.loads(self.getOrDefault(self.overrides)).items() if c in df.columns}
        shares, low = null_shares(df), self.getOrDefault(self.lowThreshold)
        return ImputeModel({
            "fills": {**typical_values(df.drop(*fixed)), **fixed}, "numeric": clean.numeric_columns(df),
            "simple": [c for c, s in shares.items() if 0 < s <= low],
            "complex": [c for c, s in shares.items() if s > low],
        })


class CapModel(_Learned):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: clip(F.col(f"`{c}`"), low, high) for c, (low, high) in self.learned.items() if c in df.columns
        })


class Cap(Estimator, _Saved):
    """Limits numeric columns to fences around the quartiles (``iqr``) or to outer quantiles (``quantile``)."""

    method = Param(Params._dummy(), "method", "iqr or quantile", TypeConverters.toString)
    factor = Param(Params._dummy(), "factor", "fence distance in interquartile ranges", TypeConverters.toFloat)
    lower = Param(Params._dummy(), "lower", "lower quantile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile", TypeConverters.toFloat)
    exclude = Param(Params._dummy(), "exclude", "columns left alone", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, method="iqr", factor=1.5, lower=0.01, upper=0.99, exclude=()):
        super().__init__()
        if method not in ("iqr", "quantile"):
            raise ValueError("method must be iqr or quantile")
        if not (0.0 < lower < 1.0 and 0.0 < upper < 1.0):
            raise ValueError("quantiles must lie in (0, 1)")
        if lower >= upper:
            raise ValueError("lower must be below upper")
        self._set(method=method, factor=factor, lower=lower, upper=upper, exclude=list(exclude))

    def _fit(self, df: DataFrame) -> CapModel:
        return self.learn(clean.numeric_columns(df), partial(exact_quantiles, df))

    def learn(self, numeric: Sequence[str], quantiles: Callable[[Sequence[str], Sequence[float]], Mapping]) -> CapModel:
        """``quantiles`` gives those of the named columns."""
        names = [c for c in numeric if c not in self.getOrDefault(self.exclude)]
        iqr = self.getOrDefault(self.method) == "iqr"
        probs = [0.25, 0.75] if iqr else [self.getOrDefault(self.lower), self.getOrDefault(self.upper)]
        bounds = {}
        for c, (low, high) in quantiles(names, probs).items():
            if low is None:
                continue
            reach = self.getOrDefault(self.factor) * (high - low) if iqr else 0.0
            bounds[c] = (low - reach, high + reach)
        return CapModel(bounds)


def cap_without_flags(flags: Sequence[str] = (), **settings) -> Cap:
    """Fences that leave ids, labels and 0/1 flags alone; ``flags`` names further ones by their name in the input."""
    return Cap(exclude=[*UNCAPPED_COLUMNS, *flags], **settings)


class ScaleModel(_Learned):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(f"`{c}`") - F.lit(mean)) / F.lit(spread or 1.0)
            for c, (mean, spread) in self.learned.items() if c in df.columns and mean is not None
        })


class Scale(Estimator, _Saved):
    """Zero mean and unit population deviation; columns that never vary are only centred."""

    columns = Param(Params._dummy(), "columns", "numeric columns; empty means all", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(columns=list(columns or []))

    def _fit(self, df: DataFrame) -> ScaleModel:
        names = self.getOrDefault(self.columns) or clean.numeric_columns(df)
        if not names:
            return ScaleModel({})
        row = df.agg(
            *[F.avg(c).alias(f"mean_{c}") for c in names], *[F.stddev_pop(c).alias(f"spread_{c}") for c in names]
        ).first()
        return ScaleModel({c: (row[f"mean_{c}"], row[f"spread_{c}"]) for c in names})


class KeepFrequentModel(_Learned):
    def _transform(self, df: DataFrame) -> DataFrame:
        """All values but the kept ones share one name, or become null if every value was kept."""
        changed = {}
        for c, learned in self.learned.items():
            if c in df.columns:
                col = F.col(f"`{c}`")
                other = F.when(col.isNotNull(), F.lit(INFREQUENT)) if learned["more"] else F.lit(None).cast("string")
                changed[c] = F.when(col.isin(learned["kept"]), col).otherwise(other) if learned["kept"] else other
        return df.withColumns(changed)


class KeepFrequent(Estimator, _Saved):
    """At most ``maxCategories`` values per column: the most frequent ones, the rest as one value.

    A value that was never seen is one of the rest, whatever the number of values; where there is no rest, as all
    values were kept, it becomes null. Of each column only the values that are kept reach the driver.
    """

    columns = Param(Params._dummy(), "columns", "text columns; empty means all", TypeConverters.toListString)
    maxCategories = Param(Params._dummy(), "maxCategories", "values per column", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, columns=None, maxCategories=20):
        super().__init__()
        self._set(columns=list(columns or []), maxCategories=maxCategories)

    def _fit(self, df: DataFrame) -> KeepFrequentModel:
        names = self.getOrDefault(self.columns) or clean.text_columns(df)
        most = self.getOrDefault(self.maxCategories)
        if not names:
            return KeepFrequentModel({})
        ranked = top_values(df, names, most + 1, first="desc")
        found = {c: [] for c in names}
        for r in sorted(ranked.collect(), key=lambda r: r["place"]):
            found[r["column"]].append(r["value"])
        return KeepFrequentModel({
            c: {"kept": values[: most - 1] if len(values) > most else values, "more": len(values) > most} for c, values in found.items()
        })


def one_hot_stages(columns: Sequence[str], most: int | None = None) -> list:
    """Indicator vectors ``<column>_hot``, categories in alphabetical order, null and values never seen as zeros.

    Every category has an indicator of its own, and the fitted model holds all their names. With ``most``, only
    that many categories per column have one, see :class:`KeepFrequent`.
    """
    index, hot = [f"{c}_index" for c in columns], [f"{c}_hot" for c in columns]
    return [
        *([KeepFrequent(columns=list(columns), maxCategories=most)] if most is not None else []),
        StringIndexer(inputCols=list(columns), outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
        # The index kept for unseen values comes last, so dropping the last one leaves them all zeros.
        OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
    ]


def hashing_stages(columns: Sequence[str], width: int = 1 << 18, output: str = "hashed_hot") -> list:
    """One sparse vector ``output`` for all the columns, of ``width`` places that a hash of column and value picks.

    Nothing is learned, so neither the number of categories nor new ones matter; two categories may share a place.
    Null is no category.
    """
    return [FeatureHasher(inputCols=list(columns), outputCol=output, numFeatures=width, categoricalCols=list(columns))]


def places(vector: str) -> Column:
    """The places of a vector's elements other than zero, in order; of a sparse one only what it stores is looked at."""
    parts = F.unwrap_udt(vector)
    stored = F.when(parts["type"] == 1, F.sequence(F.lit(0), F.size(parts["values"]) - 1)).otherwise(parts["indices"])
    pairs = F.arrays_zip(stored.alias("place"), parts["values"].alias("value"))
    empty = F.array().cast("array<int>")
    return F.when(F.size(parts["values"]) > 0, F.transform(F.filter(pairs, lambda p: p["value"] != 0), lambda p: p["place"])).otherwise(empty)


def total(vector: str) -> Column:
    """The sum of a vector's elements, from those it stores."""
    return F.aggregate(F.unwrap_udt(vector)["values"], F.lit(0.0), lambda a, b: a + b)


def preprocessor(
    df: DataFrame, label: str, keep: Sequence[str] = (), threshold: float = 0.8, most: int | None = None, hashed: int | None = None
) -> Estimator:
    """Unknowns to null, sparse columns out, outer 1% capped, gaps filled, scaled, encoded, assembled.

    Columns are routed by their types; ``df`` is a frame of the kind that ``fit`` gets, and is not read.
    ``keep`` names id columns that pass through untouched. Text columns are encoded with an indicator per category,
    with ``most`` at most that many per column; with ``hashed`` they share a vector of that width instead, for
    columns with more categories than a model should hold.
    """
    return _Preprocessor(df.columns, label, keep, threshold, most, hashed)


class _Preprocessor(Estimator):
    """Learns all its steps from the counts of one pass over the frame; ``most`` and vectors of other steps take their own."""

    def __init__(self, columns, label, keep, threshold, most, hashed):
        super().__init__()
        self.columns, self.label, self.keep = columns, label, list(keep)
        self.threshold, self.most, self.hashed = threshold, most, hashed

    def _fit(self, df: DataFrame) -> PipelineModel:
        features = df.select(*[f"`{c}`" for c in self.columns]).drop(self.label, *self.keep)
        texts = clean.text_columns(features)
        unknowns = UnknownToNull(columns=texts) if texts else UnknownToNull()
        known = unknowns.transform(features)
        counts = ValueCounts(known)
        sparse = DropSparse(threshold=self.threshold).learn(counts.null_shares())
        left = sparse.transform(known)
        numeric, texts = clean.numeric_columns(left), clean.text_columns(left)
        whole = [self.label, *self.keep, *[c for c in features.columns if c not in numeric]]
        capped = Cap(method="quantile", exclude=whole).learn(numeric, counts.quantiles)
        frequent = counts.most_frequent(texts)
        medians = {c: q[0] for c, q in counts.quantiles(numeric, [0.5], capped.learned).items()}
        modes = {c: frequent.get(c, "Unknown") for c in texts}
        filled = ImputeModel({"fills": {**medians, **modes}, "numeric": numeric, "simple": [], "complex": []})
        stages = [unknowns, sparse, capped, filled]
        if numeric:
            stages.append(ScaleModel(counts.moments(numeric, capped.learned, medians)))
        encoded = []
        if texts:
            encoded = [f"{c}_hot" for c in texts] if self.hashed is None else ["hashed_hot"]
            stages += self._encoding(texts, modes, counts, PipelineModel(stages).transform(df))
        return PipelineModel([*stages, VectorAssembler(inputCols=[*numeric, *encoded], outputCol="features")])

    def _encoding(self, texts: Sequence[str], modes: Mapping[str, str], counts: ValueCounts, filled: DataFrame) -> list:
        if self.hashed is not None:
            return hashing_stages(texts, self.hashed)
        # Indicators depend on which values there are, not on how often; limiting them looks at the rows.
        rows = filled if self.most is not None else counts.distinct(modes)
        return Pipeline(stages=one_hot_stages(texts, self.most)).fit(rows).stages


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's elements, from its metadata."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"]
    named = {a["idx"]: a.get("name", f"var_{a['idx']}") for attrs in groups.values() for a in attrs}
    return [named[i] for i in sorted(named)]
