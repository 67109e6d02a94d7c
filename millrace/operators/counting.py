"""Counts, top-k, grouped summaries, pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import exact_mean, exact_sum, steady_mean
from millrace.operators.quantiles import quantile_columns
from millrace.session import attach, require_columns, require_rows


def count_by(df: DataFrame, key: str | Column, name: str = "key") -> DataFrame:
    column = F.col(key) if isinstance(key, str) else key
    return df.groupBy(column.alias(name)).agg(F.count("*").alias("n"))


def count_each(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Counts by each of several columns, from one scan: ``dimension``, ``key``, ``n``."""
    texts = df.select(*[F.col(d).cast("string").alias(d) for d in dimensions])
    long = texts.groupingSets([[F.col(d)] for d in dimensions], *map(F.col, dimensions)).agg(
        F.count("*").alias("n"), F.grouping_id(*dimensions).alias("_g")
    )
    # bit i of grouping_id is 0 for the one column that is grouped on
    ones = (1 << len(dimensions)) - 1
    name = F.coalesce(
        *[
            F.when(F.col("_g") == ones - (1 << (len(dimensions) - 1 - i)), F.lit(d))
            for i, d in enumerate(dimensions)
        ]
    )
    return long.select(name.alias("dimension"), F.coalesce(*map(F.col, dimensions)).alias("key"), "n")


def most_common(df: DataFrame, key: str, size: int = 5) -> DataFrame:
    """The most frequent values, ties by value."""
    if size < 1:
        raise ValueError("size must be at least 1")
    return count_by(df, key).orderBy(F.desc("n"), "key").limit(size)


def error_ratio(logs: DataFrame) -> DataFrame:
    """Requests, server errors and their share in percent (NULL for no requests)."""
    errors = F.count_if(F.col("status").between(500, 599))
    return logs.agg(
        F.count("*").alias("total"),
        errors.alias("errors_5xx"),
        F.try_divide(100.0 * errors, F.count("*")).alias("ratio_pct"),
    )


def status_map(logs: DataFrame) -> DataFrame:
    """Total and a status -> count map in one row."""
    return (
        logs.groupBy("status")
        .agg(F.count("*").alias("n"))
        .agg(
            F.sum("n").alias("total"),
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("status"),
        )
    )


def event_summary(events: DataFrame) -> DataFrame:
    """Count and mean amount of positive amounts by type, most frequent first."""
    return (
        events.where(F.col("amount") > 0)
        .groupBy("event_type")
        .agg(F.count("*").alias("cnt"), steady_mean(F.col("amount")).alias("avg"))
        .orderBy(F.desc("cnt"), "event_type")
    )


EVENT_SUMMARY_SQL = """
    SELECT event_type, COUNT(*) AS cnt, COALESCE(
           CASE WHEN BOOL_AND(CAST(TRY_CAST(amount AS DECIMAL(28,12)) AS DOUBLE) = amount)
                THEN CAST(TRY_SUM(TRY_CAST(amount AS DECIMAL(28,12))) AS DOUBLE) END, SUM(amount)) / COUNT(*) AS avg
    FROM {events} WHERE amount > 0
    GROUP BY event_type ORDER BY cnt DESC, event_type
"""


def event_summary_sql(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The same query as SQL text."""
    return spark.sql(EVENT_SUMMARY_SQL, events=events)


def category_summary(sales: DataFrame, approx: bool = False, medians: DataFrame | None = None) -> DataFrame:
    """Per category: count, mean and median price, total amount, to one decimal.

    ``medians`` (category, ``_median``) saves their search when cleaning has found them: prices filled in with the
    median of their category leave it where it was.
    """
    keyed = sales.where(F.col("category").isNotNull())
    totals = keyed.groupBy("category").agg(
        F.count("unit_price").alias("n"),
        F.round(steady_mean(F.col("unit_price")), 1).alias("mean_price"),
        F.round(exact_sum(F.col("amount")), 1).cast("double").alias("total_amount"),
    )
    if medians is None:
        medians = quantile_columns(keyed, "unit_price", {"_median": 0.5}, ["category"], approx=approx)
    return totals.join(
        medians.select("category", F.round("_median", 1).alias("median_price")), "category", "left"
    )


def top_categories(sales: DataFrame, top_n: int = 10) -> DataFrame:
    """The categories with the highest sales, ranked."""
    if top_n < 1:
        raise ValueError("top_n must be at least 1")
    require_columns(sales, ["category", "amount"])
    require_rows(sales, "the sales table")
    totals = (
        sales.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(exact_sum(F.col("amount")).alias("amount"))
    )
    return rank_categories(totals, top_n)


def rank_categories(totals: DataFrame, top_n: int) -> DataFrame:
    """The highest of one total per category, with their ranks."""
    best = totals.orderBy(F.desc("amount"), "category").limit(top_n)
    # the window sees the top_n result rows only
    position = F.row_number().over(Window.orderBy(F.desc("amount"), "category"))
    return best.select(position.cast("long").alias("rank"), "category", F.col("amount").cast("double").alias("amount"))


def sales_kpi(sales: DataFrame) -> DataFrame:
    """Total sales, number of orders, mean order value."""
    return sales.agg(
        F.round(exact_sum(F.col("amount")), 2).cast("double").alias("total_sales"),
        F.count("*").alias("orders"),
        F.round(exact_mean(F.col("amount")), 1).alias("mean_order"),
    )


def class_ratio(df: DataFrame, column: str) -> DataFrame:
    """Rows per class and their share in percent, sorted by class."""
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    total = df.agg(F.count("*").alias("t")).scalar()
    return counts.select(
        column, "count", F.round(F.col("count").cast("decimal(20,0)") * 100 / total, 2).cast("double").alias("ratio_pct")
    ).orderBy(column)


def minority_share(df: DataFrame, column: str) -> DataFrame:
    return class_ratio(df, column).agg(F.min("ratio_pct").alias("minority_pct"))


def group_means(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Mean of each column and the row count per group."""
    return (
        df.groupBy(key)
        .agg(
            *[F.round(steady_mean(F.col(c)), 2).alias(f"avg_{c}") for c in columns],
            F.count("*").alias("count"),
        )
        .orderBy(key)
    )


def group_difference(df: DataFrame, key: str, columns: Sequence[str], high=1, low=0) -> DataFrame:
    """Difference of the rounded means of two groups."""

    def mean_of(c: str, group) -> Column:
        return F.round(steady_mean(F.when(F.col(key) == group, F.col(c))), 2)

    return df.agg(*[F.round(mean_of(c, high) - mean_of(c, low), 2).alias(f"diff_{c}") for c in columns])


def pivot_sum(
    df: DataFrame, row: str, column: str, value: str, columns: Sequence[str], digits: int = 1
) -> DataFrame:
    """Rows x columns table of sums; absent cells are 0, missing keys are left out."""
    table = (
        df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
        .groupBy(row)
        .pivot(column, list(columns))
        .agg(exact_sum(F.col(value)))
    )
    cells = [F.round(F.coalesce(F.col(f"`{c}`"), F.lit(0)), digits).cast("double").alias(c) for c in columns]
    return table.select(row, *cells)


def crosstab(df: DataFrame, row: str, column: str, columns: Sequence) -> DataFrame:
    """Rows x columns table of counts."""
    table = (
        df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
        .groupBy(row)
        .pivot(column, list(columns))
        .agg(F.count(F.lit(1)))
    )
    return table.select(row, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"{column}_{c}") for c in columns])


def boxplot_stats(df: DataFrame, group: str, value: str, k: float = 1.5, approx: bool = False) -> DataFrame:
    """Quartiles, whiskers and number of outliers of a value per group."""
    quartiles = quantile_columns(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group], approx=approx)
    marked = attach(df.select(group, value).dropna(), quartiles, [group], "inner").withColumn(
        "_in",
        F.col(value).between(
            F.col("q1") - k * (F.col("q3") - F.col("q1")), F.col("q3") + k * (F.col("q3") - F.col("q1"))
        ),
    )
    return marked.groupBy(group).agg(
        F.count("*").alias("n"),
        *[F.round(F.first(q), 6).alias(q) for q in ("q1", "median", "q3")],
        F.min(F.when(F.col("_in"), F.col(value))).alias("whisker_low"),
        F.max(F.when(F.col("_in"), F.col(value))).alias("whisker_high"),
        F.count_if(~F.col("_in")).alias("outliers"),
    )
