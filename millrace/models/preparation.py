"""Preprocessing learned on training rows only: impute, standardise, one-hot."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.quantiles import column_quantiles
from millrace.session import require_columns


def training_fills(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Median of each numeric and most frequent value of each categorical column.

    One row per column, its value as text: ``column``, ``fill``.
    """
    parts = []
    if numeric:
        medians = column_quantiles(rows, numeric, [0.5])
        parts.append(medians.select("column", F.get("quantiles", F.lit(0)).cast("string").alias("fill")))
    if categorical:
        long = rows.select(*[F.col(c).cast("string").alias(c) for c in categorical]).unpivot(
            [], list(categorical), "column", "value"
        )
        counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
        best = F.min(F.struct((-F.col("n")).alias("n"), "value"))
        parts.append(counts.groupBy("column").agg(best.alias("b")).select("column", F.col("b.value").alias("fill")))
    fills = parts[0]
    for part in parts[1:]:
        fills = fills.unionByName(part)
    return fills


def scaling(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation (1 where it is 0) per column, in one row."""
    parts = []
    for c in columns:
        value = F.col(c).cast("double")
        parts.append(F.avg(value).alias(f"{c}__mean"))
        parts.append(F.stddev_pop(value).alias(f"{c}__sd"))
    wide = rows.agg(*parts)
    return wide.select(
        *[
            part
            for c in columns
            for part in (
                F.col(f"{c}__mean"),
                F.when(F.col(f"{c}__sd") == 0, 1.0).otherwise(F.col(f"{c}__sd")).alias(f"{c}__sd"),
            )
        ]
    )


def standardize(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as (value - mean) / population deviation."""
    one_row = scaling(rows, columns).select(F.struct("*").alias("s")).scalar()
    scaled = {c: (F.col(c).cast("double") - F.col(f"_s.{c}__mean")) / F.col(f"_s.{c}__sd") for c in columns}
    return rows.withColumn("_s", one_row).withColumns(scaled).drop("_s")


class _PreparerParams(Params):
    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "categorical columns", TypeConverters.toListString)
    learned = Param(Params._dummy(), "learned", "fills and scales as JSON", TypeConverters.toString)


class ColumnPreparer(Estimator, _PreparerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians, modes, means and deviations of the training rows."""

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None):
        super().__init__()
        self._setDefault(numeric=[], categorical=[])
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ColumnPreparerModel:
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        require_columns(dataset, [*numeric, *categorical])
        fills = {r["column"]: r["fill"] for r in training_fills(dataset, numeric, categorical).collect()}
        empty = sorted({*numeric, *categorical} - set(fills))
        if empty:
            raise ValueError("columns without any value: " + ", ".join(empty))
        filled = dataset.select(
            *[F.coalesce(F.col(c).cast("double"), F.lit(float(fills[c]))).alias(c) for c in numeric]
        )
        scales = scaling(filled, numeric).first().asDict() if numeric else {}
        learned = json.dumps({"fills": fills, "scales": scales}, ensure_ascii=False)
        model = ColumnPreparerModel()
        return model._set(numeric=numeric, categorical=categorical, learned=learned)


class ColumnPreparerModel(Model, _PreparerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fills and standardises with what was learned."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        learned = json.loads(self.getOrDefault("learned"))
        fills, scales = learned["fills"], learned["scales"]
        changed = {}
        for c in self.getOrDefault("numeric"):
            filled = F.coalesce(F.col(c).cast("double"), F.lit(float(fills[c])))
            changed[c] = (filled - F.lit(scales[f"{c}__mean"])) / F.lit(scales[f"{c}__sd"])
        for c in self.getOrDefault("categorical"):
            changed[c] = F.coalesce(F.col(c).cast("string"), F.lit(fills[c]))
        return dataset.withColumns(changed)


def one_hot_stages(categorical: Sequence[str]) -> list:
    """Index and one-hot; a category not seen in training becomes all zeros."""
    indexed = [f"{c}__i" for c in categorical]
    encoded = [f"{c}__v" for c in categorical]
    return [
        StringIndexer(
            inputCols=list(categorical),
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
    ]


def preparation_stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    return [
        ColumnPreparer(numeric=list(numeric), categorical=list(categorical)),
        *one_hot_stages(categorical),
        VectorAssembler(inputCols=[*numeric, *[f"{c}__v" for c in categorical]], outputCol="features"),
    ]


def preparation(numeric: Sequence[str], categorical: Sequence[str]) -> Pipeline:
    return Pipeline(stages=preparation_stages(numeric, categorical))
