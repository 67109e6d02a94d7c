"""Table profiles: shape, types, missing values, numeric descriptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.quantiles import column_quantiles
from millrace.session import require_columns


def source_profile(
    df: DataFrame, required: Sequence[str] = (), sample: int = 0, order: Sequence[str] = ()
) -> DataFrame:
    """Column names, their number and the row count; with ``sample`` that many first rows by ``order``.

    The rows are one JSON text each, in ``first_rows``.
    """
    require_columns(df, [*required, *order])
    profile = _profile(df)
    if not sample:
        return profile
    first = df.orderBy(*order).limit(sample)
    keyed = F.array_sort(F.collect_list(F.struct(*order, F.to_json(F.struct(*df.columns)).alias("_row"))))
    rows = first.agg(F.transform(keyed, lambda x: x["_row"]).alias("r")).scalar()
    return profile.withColumn("first_rows", F.array_join(rows, "\n"))


def _profile(df: DataFrame) -> DataFrame:
    return df.agg(
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.count("*").alias("n_rows"),
    )


def sample_rows(df: DataFrame, size: int = 5) -> DataFrame:
    """The first rows of a table."""
    return df.limit(size)


def _per_column(df: DataFrame, counts: dict[str, list]) -> DataFrame:
    """One aggregate over all columns, then one row per column."""
    names = list(counts)
    wide = df.agg(
        *[e.alias(f"{name}__{i}") for name in names for i, e in enumerate(counts[name])]
    )
    width = len(counts[names[0]]) if names else 0
    cells = [
        F.struct(F.lit(name).alias("column"), *[F.col(f"{name}__{i}").alias(f"c{i}") for i in range(width)])
        for name in names
    ]
    return wide.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, non-null count and row count of each column."""
    types = dict(df.dtypes)
    cells = _per_column(df, {c: [F.lit(types[c]), F.count(c), F.count("*")] for c in df.columns})
    return cells.select(
        "column", F.col("c0").alias("dtype"), F.col("c1").alias("non_null"), F.col("c2").alias("n_rows")
    )


def null_counts(df: DataFrame) -> DataFrame:
    cells = _per_column(df, {c: [F.count_if(F.col(c).isNull())] for c in df.columns})
    return cells.select("column", F.col("c0").alias("nulls"))


def missing_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing values per column before and after a step, and how many it handled."""
    return (
        null_counts(before)
        .withColumnRenamed("nulls", "nulls_before")
        .join(null_counts(after).withColumnRenamed("nulls", "nulls_after"), "column")
        .withColumn("handled", F.col("nulls_before") - F.col("nulls_after"))
    )


def type_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Types side by side, with the missing values that coercion added."""
    old, new = dict(before.dtypes), dict(after.dtypes)
    shared = [c for c in before.columns if c in new]
    named = before.sparkSession.createDataFrame(
        [(c, old[c], new[c]) for c in shared], "column string, type_before string, type_after string"
    )
    changes = missing_changes(before.select(shared), after.select(shared))
    return changes.join(F.broadcast(named), "column").select(
        "column", "type_before", "type_after", (F.col("nulls_after") - F.col("nulls_before")).alias("nulls_added")
    )


def describe_numeric(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    stats = _per_column(
        df,
        {
            c: [
                F.count(c),
                F.avg(F.col(c).cast("double")),
                F.stddev_samp(F.col(c).cast("double")),
                F.min(F.col(c).cast("double")),
                F.max(F.col(c).cast("double")),
            ]
            for c in columns
        },
    )
    parts = column_quantiles(df, columns, [0.25, 0.5, 0.75], approx=approx)
    return stats.join(parts, "column", "left").select(
        "column",
        F.col("c0").alias("count"),
        F.col("c1").alias("mean"),
        F.col("c2").alias("std"),
        F.col("c3").alias("min"),
        *[F.get("quantiles", F.lit(i)).alias(q) for i, q in enumerate(["q1", "median", "q3"])],
        F.col("c4").alias("max"),
    )
