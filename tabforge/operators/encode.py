"""Category codes and column scalers as fit/transform stages that can be saved.

Fitted state is a handful of numbers or labels per column, held in stage params,
so every stage can sit in a ``PipelineModel`` and be scored in batch or stream.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.operators.profile import quoted
from tabforge.operators.quantiles import exact_quantiles
from tabforge.session import scratch_path


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Persistence mixin; params carry all state."""


# ---- scaling ---------------------------------------------------------------

SCALER_KINDS = ("none", "standard", "minmax", "robust")


class ColumnScaler(Estimator, HasInputCols, _Stage):
    """Scale named columns; NULL stays NULL.

    standard: population deviation. minmax: to 0..1. robust: median and IQR.
    A column without spread is divided by 1.
    """

    kind = Param(Params._dummy(), "kind", "none|standard|minmax|robust", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, kind="standard"):
        super().__init__()
        self._setDefault(kind="standard")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "ColumnScalerModel":
        cols, kind = self.getInputCols(), self.getOrDefault(self.kind)
        if kind not in SCALER_KINDS:
            raise ValueError(f"unknown scaler {kind}")
        xs = {c: F.col(quoted(c)).cast("double") for c in cols}
        if kind == "none":
            center, scale = [0.0] * len(cols), [1.0] * len(cols)
        elif kind == "robust":
            q = exact_quantiles(df, xs, [0.25, 0.5, 0.75])
            center = [q[c][1] for c in cols]
            scale = [q[c][2] - q[c][0] for c in cols]
        elif kind == "standard":
            row = df.agg(
                *[F.avg(xs[c]).alias(f"a{i}") for i, c in enumerate(cols)],
                *[F.stddev_pop(xs[c]).alias(f"b{i}") for i, c in enumerate(cols)],
            ).first()
            center = [row[f"a{i}"] for i in range(len(cols))]
            scale = [row[f"b{i}"] for i in range(len(cols))]
        else:
            row = df.agg(
                *[F.min(xs[c]).alias(f"a{i}") for i, c in enumerate(cols)],
                *[F.max(xs[c]).alias(f"b{i}") for i, c in enumerate(cols)],
            ).first()
            center = [row[f"a{i}"] for i in range(len(cols))]
            scale = [row[f"b{i}"] - row[f"a{i}"] for i in range(len(cols))]
        scale = [float(s) if s else 1.0 for s in scale]
        return ColumnScalerModel(inputCols=cols, center=[float(c or 0.0) for c in center], scale=scale)


class ColumnScalerModel(Model, HasInputCols, _Stage):
    center = Param(Params._dummy(), "center", "subtracted per column", TypeConverters.toListFloat)
    scale = Param(Params._dummy(), "scale", "divisor per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, center=None, scale=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _replace(self, df: DataFrame, fn) -> DataFrame:
        spec = {
            c: (m, s)
            for c, m, s in zip(self.getInputCols(), self.getOrDefault(self.center), self.getOrDefault(self.scale))
        }
        return df.select(
            *[fn(F.col(quoted(c)), *spec[c]).alias(c) if c in spec else F.col(quoted(c)) for c in df.columns]
        )

    def _transform(self, df: DataFrame) -> DataFrame:
        return self._replace(df, lambda x, m, s: (x - F.lit(m)) / F.lit(s))

    def inverse(self, df: DataFrame) -> DataFrame:
        """Back to the original units."""
        return self._replace(df, lambda x, m, s: x * F.lit(s) + F.lit(m))


# ---- labels ----------------------------------------------------------------

#: Labels that a model carries itself; a larger dictionary is a table that rows are joined with.
MAX_LABELS = 20_000


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a dictionary, refusing one too large to hold on the driver."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}: use label_codes and a join instead")
    return rows


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(label, code) in text order as a table, for dictionaries of any size."""
    from tabforge.operators.prefix import global_positions

    labels = df.select(F.col(quoted(column)).cast("string").alias("label")).where(F.col("label").isNotNull()).distinct()
    return global_positions(labels, ["label"], "code")


class LabelCoder(Estimator, HasInputCols, _Stage):
    """Integer codes in text order. NULL stays NULL, or becomes the label 'nan'.

    A dictionary of more than ``MAX_LABELS`` labels is written to ``dictionaryPath``, a folder
    that must last as long as the model (default: one in the checkpoint folder).
    """

    missingAsLabel = Param(Params._dummy(), "missingAsLabel", "NULL is the label 'nan'", TypeConverters.toBoolean)
    dictionaryPath = Param(Params._dummy(), "dictionaryPath", "folder for large dictionaries", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, missingAsLabel=False, dictionaryPath=None):
        super().__init__()
        self._setDefault(missingAsLabel=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "LabelCoderModel":
        flag = self.getOrDefault(self.missingAsLabel)
        labels, tables = {}, {}
        for c in self.getInputCols():
            x = F.col(quoted(c)).cast("string")
            own = df.select((F.coalesce(x, F.lit("nan")) if flag else x).alias("v")).where(F.col("v").isNotNull()).distinct()
            found = own.orderBy("v").limit(MAX_LABELS + 1).collect()
            if len(found) <= MAX_LABELS:
                labels[c] = [r["v"] for r in found]
                continue
            folder = self.getOrDefault(self.dictionaryPath) if self.isDefined(self.dictionaryPath) else scratch_path(df.sparkSession, "labels")
            tables[c] = f"{folder}/{len(tables)}"
            label_codes(own, "v").write.mode("overwrite").parquet(tables[c])
        return LabelCoderModel(inputCols=self.getInputCols(), labels=json.dumps(labels), missingAsLabel=flag, tables=json.dumps(tables))


class LabelCoderModel(Model, HasInputCols, _Stage):
    labels = Param(Params._dummy(), "labels", "ordered labels per column as JSON", TypeConverters.toString)
    missingAsLabel = Param(Params._dummy(), "missingAsLabel", "NULL is the label 'nan'", TypeConverters.toBoolean)
    tables = Param(Params._dummy(), "tables", "folder of (label, code) per column with a large dictionary, JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, labels=None, missingAsLabel=False, tables="{}"):
        super().__init__()
        self._setDefault(missingAsLabel=False, tables="{}")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def label_lists(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault(self.labels))

    def code_of(self, column: str) -> Column:
        values = self.label_lists()[column]
        x = F.col(quoted(column)).cast("string")
        if self.getOrDefault(self.missingAsLabel):
            x = F.coalesce(x, F.lit("nan"))
        mapping = F.create_map(*[F.lit(v) for i, label in enumerate(values) for v in (label, i)])
        return F.when(x.isNotNull(), F.element_at(mapping, x)).cast("int")

    def label_of(self, code: Column, column: str) -> Column:
        """Inverse: the label of a code."""
        arr = F.array(*[F.lit(v) for v in self.label_lists()[column]])
        return F.get(arr, code.cast("int"))

    def _dictionary(self, df: DataFrame, column: str) -> DataFrame:
        return df.sparkSession.read.parquet(json.loads(self.getOrDefault(self.tables))[column])

    def n_labels(self, df: DataFrame, column: str) -> int:
        small = self.label_lists()
        return len(small[column]) if column in small else self._dictionary(df, column).count()

    def decode(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with the codes of a column replaced by their labels, whatever the dictionary's size."""
        if column in self.label_lists():
            return df.withColumn(column, self.label_of(F.col(quoted(column)), column))
        met = df.join(self._dictionary(df, column).toDF("_label", "_code"), F.col(quoted(column)) == F.col("_code"), "left")
        return met.select(*[F.col("_label").alias(c) if c == column else F.col(quoted(c)) for c in df.columns])

    def _transform(self, df: DataFrame) -> DataFrame:
        small = set(self.label_lists())
        out = df.select(*[self.code_of(c).alias(c) if c in small else F.col(quoted(c)) for c in df.columns])
        for column in json.loads(self.getOrDefault(self.tables)):
            x = F.col(quoted(column)).cast("string")
            x = F.coalesce(x, F.lit("nan")) if self.getOrDefault(self.missingAsLabel) else x
            met = out.join(self._dictionary(df, column).toDF("_label", "_code"), x == F.col("_label"), "left")
            out = met.select(*[F.col("_code").cast("int").alias(c) if c == column else F.col(quoted(c)) for c in out.columns])
        return out


class SentinelCleaner(Transformer, _Stage):
    """Stage form of the sentinel rule: JSON map column -> value meaning missing."""

    rules = Param(Params._dummy(), "rules", "column -> sentinel, JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, rules=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        from tabforge.operators.clean import clean_sentinels

        return clean_sentinels(df, json.loads(self.getOrDefault(self.rules)))
