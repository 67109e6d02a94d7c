"""Checked lookup joins and comparison of two results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import attach

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join to a table with a unique key; ``_merge`` tells where a row was found."""
    repeated = lookup.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"lookup key {key} is not unique")
    marked = lookup.withColumn("_found", F.lit(True))
    merge = F.when(F.col("_found"), "both").otherwise("left_only")
    return attach(rows, marked, [key]).withColumn("_merge", merge).drop("_found")


def lookup_counts(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows before and after the join and per origin; fails when the join changed the count."""
    before = rows.agg(F.count("*").alias("c")).scalar()
    counts = joined.agg(
        F.count("*").alias("rows_after"),
        F.count_if(F.col("_merge") == "both").alias("both"),
        F.count_if(F.col("_merge") == "left_only").alias("left_only"),
    ).withColumn("rows_before", before)
    changed = F.raise_error(F.lit("the join changed the number of rows")).cast("long")
    same = F.col("rows_before") == F.col("rows_after")
    return counts.select(
        F.when(same, F.col("rows_before")).otherwise(changed).alias("rows_before"), "rows_after", "both", "left_only"
    )


def result_difference(
    left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: float = 1e-6
) -> DataFrame:
    """Rows that differ between two results: keys and ``difference``.

    Order and numeric types do not matter; numbers may differ by ``tolerance``.
    Keys must be unique on both sides.
    """
    values = [c for c in left.columns if c not in keys]
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("the results have different columns")
    types = dict(left.dtypes)
    a = left.select(*keys, F.struct(*[F.col(c) for c in values], F.lit(1).alias("_in")).alias("_a"))
    b = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        F.struct(*[F.col(c) for c in values], F.lit(1).alias("_in")).alias("_b"),
    )
    matched = F.lit(True)
    for k in keys:
        matched = matched & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    both = a.join(b, matched, "full")
    equal = F.lit(True)
    for c in values:
        x, y = F.col(f"_a.{c}"), F.col(f"_b.{c}")
        same = x.eqNullSafe(y)
        if types[c].split("(")[0] in NUMERIC:
            near = F.abs(x.cast("double") - y.cast("double")) <= tolerance
            same = same | F.coalesce(near, F.lit(False))
        equal = equal & same
    kind = (
        F.when(F.col("_b").isNull(), "left_only").when(F.col("_a").isNull(), "right_only").when(~equal, "differs")
    )
    named = [F.when(F.col("_a").isNotNull(), F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) for k in keys]
    return both.select(*named, kind.alias("difference")).where(F.col("difference").isNotNull())


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """True when both tables hold the same rows, however often each occurs.

    Compares the row count and two order-free sums of 64-bit hashes over all columns, one
    pass per side and no shuffle of rows; a difference is missed with a chance of 2^-64.
    """

    def digest(df: DataFrame) -> tuple:
        every = [F.col(f"`{c}`") for c in sorted(df.columns)]
        sums = [F.sum(F.xxhash64(F.lit(seed), *every).cast("decimal(20,0)")) for seed in (1, 2)]
        return tuple(df.agg(F.count("*"), *sums).first())

    return sorted(left.dtypes) == sorted(right.dtypes) and digest(left) == digest(right)
