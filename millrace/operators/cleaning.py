"""Cleaning steps: coercion, imputation, winsorising. No step drops a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import clip, to_day, to_number
from millrace.operators.quantiles import column_quantiles, quantile_columns
from millrace.session import materialize

INTEGER_TYPES = ("tinyint", "smallint", "int", "bigint")


def coerce(df: DataFrame, numbers: dict[str, str] | None = None, days: Sequence[str] = ()) -> DataFrame:
    """Texts to numbers of the given types and to dates; what does not parse is missing.

    A column that is no text has been typed by its reader and is only cast; whole
    numbers stay whole where a double is asked for.
    """
    types = dict(df.dtypes)
    changed = {
        c: to_number(F.col(c), kind) if types[c] == "string" else F.col(c).try_cast(kind)
        for c, kind in (numbers or {}).items()
        if types[c] != kind and not (kind == "double" and types[c] in INTEGER_TYPES)
    }
    changed |= {c: to_day(F.col(c)) if types[c] == "string" else F.col(c).try_cast("date") for c in days}
    return df.withColumns(changed) if changed else df


def null_where(df: DataFrame, column: str, broken: Column) -> DataFrame:
    """A value that breaks a rule becomes missing."""
    return df.withColumn(column, F.when(~F.coalesce(broken, F.lit(False)), F.col(column)))


def count_where(df: DataFrame, broken: Column, name: str = "invalid_count") -> DataFrame:
    return df.agg(F.count_if(broken).alias(name))


def _or_fail(value: Column, message: str, kind: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(message)).cast(kind))


def fill_group_median(
    df: DataFrame, value: str, key: str, approx: bool = False, medians: DataFrame | None = None
) -> DataFrame:
    """Missing values get the median of their group; a group without any value fails.

    ``medians`` (key, ``_median``), if given, is stored and saves their search.
    """
    if medians is None:
        medians = materialize(quantile_columns(df, value, {"_median": 0.5}, [key], approx=approx), "medians")
    filled = F.coalesce(F.col(value).cast("double"), F.col("_median"))
    return (
        df.join(medians.select(key, "_median"), [key], "left")
        .withColumn(value, _or_fail(filled, f"{value} is still missing after the group median", "double"))
        .select(*df.columns)
    )


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value, the smallest one of a tie, as a one-row table."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("_c"))
        .orderBy(F.desc("_c"), column)
        .limit(1)
        .select(column)
    )


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    """Missing values get the most frequent value; fails when there is none."""
    kind = dict(df.dtypes)[column]
    filled = F.coalesce(F.col(column), most_frequent(df, column).scalar())
    return df.withColumn(column, _or_fail(filled, f"{column} has no most frequent value", kind))


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], k: float = 1.5, approx: bool = False, quartiles: DataFrame | None = None
) -> DataFrame:
    """``q1 - k*iqr`` and ``q3 + k*iqr`` per column, and the bounds to clip to.

    Integer columns are clipped to whole numbers inside the bounds. ``quartiles`` (column, q1, q3), if given,
    saves their search.
    """
    types = dict(df.dtypes)
    whole = F.col("column").isin(*[c for c in columns if types[c] in INTEGER_TYPES])
    if quartiles is None:
        q1, q3 = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(1))
        quartiles = column_quantiles(df, columns, [0.25, 0.75], approx=approx).select("column", q1.alias("q1"), q3.alias("q3"))
    return (
        quartiles.select("column", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))
        .select("column", (F.col("q1") - k * F.col("iqr")).alias("lower"), (F.col("q3") + k * F.col("iqr")).alias("upper"))
        .select(
            "*",
            F.when(whole, F.ceil("lower")).otherwise(F.col("lower")).cast("double").alias("clip_low"),
            F.when(whole, F.floor("upper")).otherwise(F.col("upper")).cast("double").alias("clip_high"),
        )
    )


def _bounds_row(bounds: DataFrame, columns: Sequence[str]) -> Column:
    """All bounds as one struct, read by the rows as a scalar subquery."""
    fields = [
        F.max(F.when(F.col("column") == c, F.col(part))).alias(f"{c}__{part}")
        for c in columns
        for part in ("lower", "upper", "clip_low", "clip_high")
    ]
    return bounds.agg(F.struct(*fields).alias("b")).scalar()


def winsorize(
    df: DataFrame, columns: Sequence[str], k: float = 1.5, approx: bool = False, quartiles: DataFrame | None = None
) -> DataFrame:
    """Clip the columns to their IQR bounds; types and missing values stay."""
    types = dict(df.dtypes)
    bounded = df.withColumn("_b", _bounds_row(iqr_bounds(df, columns, k, approx, quartiles), columns))
    clipped = {
        c: clip(F.col(c), F.col(f"_b.{c}__clip_low").cast(types[c]), F.col(f"_b.{c}__clip_high").cast(types[c]))
        for c in columns
    }
    return bounded.withColumns(clipped).select(*df.columns)


def winsorize_report(
    df: DataFrame, columns: Sequence[str], k: float = 1.5, approx: bool = False
) -> DataFrame:
    """Bounds, outlier count and range before and after clipping, per column.

    A missing value counts as an outlier. Clipping keeps order, so the range after
    it follows from the range before and the rows are read once.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    bounded = values.withColumn("_b", _bounds_row(iqr_bounds(df, columns, k, approx), columns))
    wide = bounded.agg(
        F.first("_b").alias("_b"),
        *[
            F.count_if(
                F.col(c).isNull() | ~F.col(c).between(F.col(f"_b.{c}__lower"), F.col(f"_b.{c}__upper"))
            ).alias(f"{c}__out")
            for c in columns
        ],
        *[F.min(c).alias(f"{c}__min") for c in columns],
        *[F.max(c).alias(f"{c}__max") for c in columns],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_b.{c}__lower").alias("lower"),
            F.col(f"_b.{c}__upper").alias("upper"),
            F.col(f"{c}__out").alias("outliers"),
            F.col(f"{c}__min").alias("min_before"),
            F.col(f"{c}__max").alias("max_before"),
            _after(f"{c}__min", c).alias("min_after"),
            _after(f"{c}__max", c).alias("max_after"),
        )
        for c in columns
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _after(extreme: str, column: str) -> Column:
    return clip(F.col(extreme), F.col(f"_b.{column}__clip_low"), F.col(f"_b.{column}__clip_high"))


def require_complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows pass through; the first missing value in a needed column fails the job."""
    types = dict(df.dtypes)
    checked = {c: _or_fail(F.col(c), f"{c} is missing after cleaning", types[c]) for c in columns}
    return df.withColumns(checked)
