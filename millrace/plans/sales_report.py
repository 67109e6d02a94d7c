"""Sales cleaning and the data of the sales report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import discounted_amount, exact_sum
from millrace.operators import cleaning
from millrace.operators.counting import rank_categories
from millrace.operators.quantiles import Request, quantile_requests
from millrace.session import materialize, require_columns, require_rows

REQUIRED = ("category", "quantity", "unit_price", "discount")


def with_amount(sales: DataFrame) -> DataFrame:
    """Add ``amount``, the discounted value of a sale to two decimals."""
    return sales.withColumn(
        "amount", discounted_amount(F.col("quantity"), F.col("unit_price"), F.col("discount"))
    )


def normalize_types(sales: DataFrame) -> DataFrame:
    """Price, quantity and date of raw sales; what does not parse is missing."""
    return cleaning.coerce(sales, {"unit_price": "double", "quantity": "double"}, ["order_date"])


def clean_sales(sales: DataFrame, approx: bool = False) -> DataFrame:
    """Coerce, price rule, group median, winsorised quantity, completeness, amount.

    No row is dropped; a value still missing at the end fails the job.
    """
    return cleaned_with_medians(sales, approx)[0]


def priced_sales(sales: DataFrame) -> DataFrame:
    """Typed sales whose prices are above 0 or missing."""
    typed = cleaning.coerce(sales, {"unit_price": "double", "quantity": "double", "discount": "double"})
    return cleaning.null_where(typed, "unit_price", F.col("unit_price") <= 0)


def cleaned_with_medians(sales: DataFrame, approx: bool = False) -> tuple[DataFrame, DataFrame]:
    """The cleaned sales, and the median price of each category (``_median``), stored.

    Medians and quartiles of the sales come from one search. ``sales`` is read by it and by the result: store what
    is dear to compute.
    """
    require_columns(sales, REQUIRED)
    require_rows(sales, "the sales table")
    priced = priced_sales(sales)
    answers = quantile_requests(
        priced, [Request("price", "unit_price", (0.5,), ("category",)), Request("quantity", "quantity", (0.25, 0.75))], approx
    )
    medians = answers["price"].withColumnRenamed("q0", "_median")
    quartiles = answers["quantity"].select(F.lit("quantity").alias("column"), F.col("q0").alias("q1"), F.col("q1").alias("q3"))
    filled = cleaning.fill_group_median(priced, "unit_price", "category", approx, medians)
    bounded = cleaning.winsorize(filled, ["quantity"], approx=approx, quartiles=quartiles)
    return with_amount(cleaning.require_complete(bounded, REQUIRED)), medians


def clean_sales_fully(sales: DataFrame, approx: bool = False) -> DataFrame:
    """The exploratory variant: region by mode, price and quantity winsorised."""
    typed = normalize_types(sales)
    priced = cleaning.null_where(typed, "unit_price", F.col("unit_price") <= 0)
    filled = cleaning.fill_mode(cleaning.fill_group_median(priced, "unit_price", "category", approx), "region")
    return with_amount(cleaning.winsorize(filled, ["unit_price", "quantity"], approx=approx))


def report_rows(cleaned: DataFrame, top_n: int = 10) -> DataFrame:
    """The report as one table: a KPI row (rank 0) and the ranked categories.

    The sales are read once, into totals per category that are stored; head and body
    of the report both follow from them.
    """
    require_columns(cleaned, ["category", "amount"])
    totals = cleaned.groupBy("category").agg(
        exact_sum(F.col("amount")).alias("amount"), F.count("amount").alias("n"), F.count("*").alias("rows")
    )
    return report_of_totals(totals, top_n)


def report_of_totals(totals: DataFrame, top_n: int = 10) -> DataFrame:
    """The report from ``category``, ``amount``, ``n`` (sales with an amount) and ``rows``."""
    if top_n < 1:
        raise ValueError("top_n must be at least 1")
    totals = materialize(totals, "category-totals")
    sums = totals.agg(
        F.sum("amount").cast("double").alias("amount"), F.sum("n").alias("n"), F.sum("rows").alias("rows")
    )
    nothing = F.lit(None).cast("long"), F.lit(None).cast("double")
    head = sums.select(
        F.lit(0).cast("long").alias("rank"),
        F.lit("total").alias("category"),
        "amount",
        F.col("rows").alias("orders"),
        F.round(F.try_divide("amount", F.col("n").cast("double")), 1).alias("mean_order"),
    )
    body = rank_categories(totals.where(F.col("category").isNotNull()), top_n).select(
        "*", nothing[0].alias("orders"), nothing[1].alias("mean_order")
    )
    return head.unionByName(body)


def sales_report(sales: DataFrame, top_n: int = 10, approx: bool = False) -> DataFrame:
    return report_rows(clean_sales(sales, approx), top_n)
