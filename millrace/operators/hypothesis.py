"""Welch's t-test and the chi-square test of independence."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.pvalues import chi_square_tail, t_two_sided
from millrace.functions.scalars import SIGNIFICANCE_LEVEL, significance
from millrace.session import materialize


def welch_statistics(df: DataFrame, value: str, group: str, first=1, second=0) -> DataFrame:
    """t statistic and Welch-Satterthwaite degrees of freedom; a group without values fails the job."""
    empty = F.raise_error(F.lit("both groups need at least one value")).cast("long")
    both = (F.col("n_a") > 0) & (F.col("n_b") > 0)
    return _welch(df, value, group, first, second).withColumn("n_a", F.when(both, F.col("n_a")).otherwise(empty))


def _welch(df: DataFrame, value: str, group: str, first, second) -> DataFrame:
    """One row from one aggregate; NULL statistics where a group is empty."""
    parts = []
    for tag, level in (("a", first), ("b", second)):
        member = F.when(F.col(group) == level, F.col(value).cast("double"))
        parts += [
            F.count(member).alias(f"n_{tag}"),
            F.avg(member).alias(f"m_{tag}"),
            F.var_samp(member).alias(f"v_{tag}"),
        ]
    s = df.agg(*parts).select(
        "*", (F.col("v_a") / F.col("n_a")).alias("s_a"), (F.col("v_b") / F.col("n_b")).alias("s_b")
    )
    spread = F.col("s_a") + F.col("s_b")
    dof = spread * spread / (
        F.col("s_a") * F.col("s_a") / (F.col("n_a") - 1) + F.col("s_b") * F.col("s_b") / (F.col("n_b") - 1)
    )
    return s.select(
        "n_a", "n_b", ((F.col("m_a") - F.col("m_b")) / F.sqrt(spread)).alias("t_statistic"), dof.alias("dof")
    )


def welch_t(df: DataFrame, value: str, group: str, first=1, second=0) -> dict:
    """Statistic, degrees of freedom and two-sided p-value, from one aggregate."""
    row = _welch(df, value, group, first, second).first().asDict()
    if not row["n_a"] or not row["n_b"]:
        raise ValueError("both groups need at least one value")
    row["p_value"] = t_two_sided(row["t_statistic"], row["dof"])
    row["significant"] = row["p_value"] < SIGNIFICANCE_LEVEL
    return row


def chi_square_statistics(df: DataFrame, row: str, column: str) -> DataFrame:
    """Statistic and degrees of freedom; Yates' correction for a 2 x 2 table.

    The rows are read once, into one stored count per seen (row level, column level); the
    windows run over the cells of one level each. An absent cell has the count 0 and adds its expected
    count, so all absent ones together add ``n`` minus the expected counts seen.
    """
    cells = (
        df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
        .groupBy(F.col(row).alias("r"), F.col(column).alias("c"))
        .agg(F.count("*").alias("o"))
    )
    cells = materialize(cells, "cells")
    by_row, by_column = Window.partitionBy("r"), Window.partitionBy("c")
    full = cells.select(
        "r",
        "c",
        "o",
        F.sum("o").over(by_row).alias("r_total"),
        F.sum("o").over(by_column).alias("c_total"),
        F.count("*").over(by_row).alias("r_cells"),
        F.count("*").over(by_column).alias("c_cells"),
        cells.agg(F.sum("o").alias("n")).scalar().alias("n"),
    )
    full = full.withColumn("e", F.col("r_total") * F.col("c_total") / F.col("n"))
    full = full.withColumn("gap", F.abs(F.col("o") - F.col("e")))
    sums = full.agg(
        F.sum(F.col("gap") * F.col("gap") / F.col("e")).alias("seen"),
        F.sum("e").alias("expected"),
        F.max("gap").alias("gap"),
        F.max("n").alias("n"),
        F.count_distinct("r").alias("r_levels"),
        F.count_distinct("c").alias("c_levels"),
        F.sum(1.0 / (F.col("r_total") * F.col("r_cells"))).alias("r_inverse"),
        F.sum(1.0 / (F.col("c_total") * F.col("c_cells"))).alias("c_inverse"),
    )
    dof = (F.col("r_levels") - 1) * (F.col("c_levels") - 1)
    # the four gaps of a 2 x 2 table are equal; sum(1/e) = n * sum(1/r) * sum(1/c)
    shrunk = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
    yates = shrunk * shrunk * F.col("n") * F.col("r_inverse") * F.col("c_inverse")
    plain = F.col("seen") + F.col("n") - F.col("expected")
    return sums.select(F.when(dof == 1, yates).otherwise(plain).alias("chi2_statistic"), dof.alias("dof"))


def chi_square(df: DataFrame, row: str, column: str) -> dict:
    """Statistic, degrees of freedom and p-value."""
    found = chi_square_statistics(df, row, column).first()
    if not found["dof"] or found["dof"] < 1:
        raise ValueError("the test needs at least two levels on both sides")
    p_value = chi_square_tail(found["chi2_statistic"], found["dof"])
    return {**found.asDict(), "p_value": p_value, "significant": p_value < SIGNIFICANCE_LEVEL}


def with_p_value(statistics: DataFrame, statistic: str, dof: str, tail: str) -> DataFrame:
    """Add ``p_value`` and ``verdict`` to the one result row of a test (``t`` or ``chi2``)."""
    function = {"t": t_two_sided, "chi2": chi_square_tail}[tail]

    @F.pandas_udf("double")
    def p_of(x: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([function(float(a), float(b)) for a, b in zip(x, k)])

    return statistics.withColumn("p_value", p_of(F.col(statistic).cast("double"), F.col(dof).cast("double"))).withColumn(
        "verdict", significance(F.col("p_value"))
    )
