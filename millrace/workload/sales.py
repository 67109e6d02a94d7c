"""Registered queries on sales: scalar steps, profiling, cleaning, summaries, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import scalars
from millrace.operators import cleaning, counting, lookup, profiling
from millrace.plans import sales_report as plan
from millrace.workload import views as v
from millrace.workload.logs import rounded

MEASURES = ["quantity", "unit_price", "discount"]


def _typed_texts(spark: SparkSession, sf: str) -> DataFrame:
    kinds = {"unit_price": "double", "quantity": "double", "discount": "double"}
    return cleaning.coerce(v.sales_texts(spark, sf), kinds, ["order_date"])


def _priced(sales: DataFrame) -> DataFrame:
    return cleaning.null_where(sales, "unit_price", F.col("unit_price") <= 0)


def _filled(sales: DataFrame) -> DataFrame:
    return cleaning.fill_group_median(_priced(sales), "unit_price", "category")


# what the amount of a sale follows from
COST = ("category", "quantity", "unit_price", "discount")


def _cleaned(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return plan.clean_sales(v.sales_table(spark, sf, *COST, *more))


def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    return _typed_texts(spark, sf)


def sales_amount(spark: SparkSession, sf: str) -> DataFrame:
    typed = _priced(v.sales_raw(spark, sf))  # no price, no amount: the row stays
    return plan.with_amount(typed).select("order_id", "amount")


def fine_amount(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts of sales priced to five decimals, with discounts to five decimals."""
    fine = v.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.round(F.col("l_extendedprice") * 100).cast("bigint") / F.lit(100_000)).alias("unit_price"),
        ((F.col("l_orderkey") % 99_991) / F.lit(100_000)).alias("discount"),
    )
    return plan.with_amount(fine).select("order_id", "amount")


def high_price_flag(spark: SparkSession, sf: str) -> DataFrame:
    """Sales above the price limit, by category."""
    flag = scalars.high_price_flag(F.col("unit_price"), 50_000)
    return _priced(v.sales_raw(spark, sf)).groupBy("category", flag.cast("long").alias("high_price_flag")).agg(
        F.count("*").alias("n")
    )


def profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.profile_columns(_priced(v.sales_raw(spark, sf)))


def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    described = profiling.describe_numeric(_priced(v.sales_table(spark, sf, *MEASURES)), MEASURES)
    return rounded(rounded(described, "std", "q1", "median", "q3"), "mean", digits=9)


def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.null_counts(_priced(v.sales_raw(spark, sf)))


def coercion_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.type_changes(v.sales_texts(spark, sf), _typed_texts(spark, sf))


def invalid_to_null(spark: SparkSession, sf: str) -> DataFrame:
    """Prices that break the rule, and missing prices once they are taken out."""
    broken = F.col("unit_price") <= 0
    before = v.sales_raw(spark, sf)
    invalid = cleaning.count_where(before, broken)
    missing = cleaning.null_where(before, "unit_price", broken).agg(F.count_if(F.col("unit_price").isNull()).alias("c"))
    return invalid.withColumn("missing_after", missing.scalar())


def impute_group_median(spark: SparkSession, sf: str) -> DataFrame:
    return _filled(v.sales_table(spark, sf, "order_id", "category", "unit_price"))


def impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    filled = cleaning.fill_mode(_priced(v.sales_raw(spark, sf)), "region")
    return filled.groupBy("region").agg(F.count("*").alias("n"))


def iqr_bounds(spark: SparkSession, sf: str) -> DataFrame:
    bounds = cleaning.iqr_bounds(_filled(v.sales_table(spark, sf, "category", "unit_price", "quantity")), ["unit_price", "quantity"])
    return rounded(bounds.select("column", "lower", "upper"), "lower", "upper")


def winsorize(spark: SparkSession, sf: str) -> DataFrame:
    clipped = cleaning.winsorize(_filled(v.sales_table(spark, sf, "order_id", "category", "unit_price", "quantity")), ["unit_price", "quantity"])
    return rounded(clipped.select("order_id", "unit_price", "quantity"), "unit_price", digits=4)


def winsorize_report(spark: SparkSession, sf: str) -> DataFrame:
    report = cleaning.winsorize_report(_filled(v.sales_table(spark, sf, "category", "unit_price", "quantity")), ["unit_price", "quantity"])
    numbers = [c for c in report.columns if c not in ("column", "outliers")]
    return rounded(report, *numbers, digits=4)


def missing_changes(spark: SparkSession, sf: str) -> DataFrame:
    sales = v.sales_table(spark, sf)
    before = _priced(sales)
    after = cleaning.fill_mode(_filled(sales), "region")
    return profiling.missing_changes(before, after)


def clean_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(spark, sf, "order_id").select("order_id", *COST, "amount")


def category_summary(spark: SparkSession, sf: str) -> DataFrame:
    cleaned, medians = plan.cleaned_with_medians(v.sales_table(spark, sf, *COST))
    return counting.category_summary(cleaned, medians=medians)


def top_categories(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(counting.top_categories(_cleaned(spark, sf), 3), "amount", digits=2)


def sales_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return counting.sales_kpi(_cleaned(spark, sf))


def sales_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return counting.pivot_sum(_cleaned(spark, sf, "region"), "category", "region", "amount", v.REGIONS)


def sales_report(spark: SparkSession, sf: str) -> DataFrame:
    return plan.sales_report(v.sales_table(spark, sf, *COST), 10)


def category_names(spark: SparkSession) -> DataFrame:
    """Category labels; some categories have none."""
    pairs = [("ECONOMY", "economy goods"), ("SMALL", "small goods"), ("LARGE", "large goods"), ("PROMO", "promotion")]
    return spark.createDataFrame(pairs, "category string, label string")


def lookup_labels(spark: SparkSession, sf: str) -> DataFrame:
    joined = lookup.lookup_join(v.sales_raw(spark, sf), category_names(spark), "category")
    return joined.groupBy("category", "label", "_merge").agg(F.count("*").alias("n"))


def lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with the name of their nation; one nation is taken out of the lookup."""
    nations = v.table(spark, sf, "nation").where("n_nationkey <> 7")
    names = nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup.lookup_join(v.table(spark, sf, "customer"), names, "c_nationkey").select(
        "c_custkey", "c_nationkey", "n_name", "_merge"
    )


def lookup_join_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.lookup_counts(v.table(spark, sf, "customer"), lookup_join(spark, sf))


QUERIES = {
    "coerce_types": coerce_types,
    "sales_amount": sales_amount,
    "fine_amount": fine_amount,
    "high_price_flag": high_price_flag,
    "profile_columns": profile_columns,
    "describe_numeric": describe_numeric,
    "null_counts": null_counts,
    "coercion_nulls": coercion_nulls,
    "invalid_to_null": invalid_to_null,
    "impute_group_median": impute_group_median,
    "impute_mode": impute_mode,
    "iqr_bounds": iqr_bounds,
    "winsorize": winsorize,
    "winsorize_report": winsorize_report,
    "missing_changes": missing_changes,
    "clean_sales": clean_sales,
    "category_summary": category_summary,
    "top_categories": top_categories,
    "sales_kpi": sales_kpi,
    "sales_pivot": sales_pivot,
    "sales_report": sales_report,
    "lookup_labels": lookup_labels,
    "lookup_join": lookup_join,
    "lookup_join_counts": lookup_join_counts,
}

# --- SQL twins -------------------------------------------------------------

SALES_COLUMNS = {
    "order_id": "string",
    "order_date": "date",
    "region": "string",
    "category": "string",
    "quantity": "bigint",
    "unit_price": "double",
    "discount": "double",
}


def _each(columns, template: str) -> str:
    return "\nUNION ALL ".join(template.format(c=c) for c in columns)


_NULLS = "SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM "
_MODE = "(SELECT region FROM priced WHERE region IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, region LIMIT 1)"
_MEAN_PRICE = "avg(unit_price)"
_SUM_AMOUNT = "sum(CAST(amount AS DECIMAL(18,2)))"
_TOP = f"""SELECT category, {_SUM_AMOUNT} AS amount FROM cleaned WHERE category IS NOT NULL GROUP BY 1"""
_NUMBERED = "SELECT row_number() OVER (ORDER BY amount DESC, category) AS rank, category, CAST(amount AS DOUBLE) AS amount"
_REPORT = """
    SELECT '{c}' AS "column", round(lower, 4) AS lower, round(upper, 4) AS upper,
        count(*) FILTER ({c} IS NULL OR {c} NOT BETWEEN lower AND upper) AS outliers,
        round(CAST(min({c}) AS DOUBLE), 4) AS min_before, round(CAST(max({c}) AS DOUBLE), 4) AS max_before,
        round(CAST(min(greatest({lo}, least({hi}, {c}))) AS DOUBLE), 4) AS min_after,
        round(CAST(max(greatest({lo}, least({hi}, {c}))) AS DOUBLE), 4) AS max_after
    FROM filled, {bounds} GROUP BY lower, upper
"""
_PIVOT_CELLS = ", ".join(
    f"round(CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (region = '{r}'), 0) AS DECIMAL(18,2)), 1)"
    f"::DOUBLE AS \"{r}\""
    for r in v.REGIONS
)
_KPI = f"""round({_SUM_AMOUNT}, 2)::DOUBLE AS total_sales, count(*) AS orders,
    round(CAST({_SUM_AMOUNT} AS DOUBLE) / count(*), 1) AS mean_order"""
_LOOKUP = """
    SELECT c_custkey, c_nationkey, n_name, CASE WHEN n_name IS NULL THEN 'left_only' ELSE 'both' END AS _merge
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) ON c_nationkey = n_nationkey
"""

ORACLES = {
    "coerce_types": v.sales_sql("SELECT * FROM typed", broken=True),
    "sales_amount": v.sales_sql(f"SELECT order_id, {v.AMOUNT_SQL} AS amount FROM priced"),
    # whole hundred-thousandths multiplied: nothing is rounded before the product
    "fine_amount": """SELECT l_orderkey || '-' || l_linenumber AS order_id,
        CAST(round(CAST(CAST(l_quantity AS BIGINT) * CAST(round(l_extendedprice * 100) AS BIGINT)
            AS DECIMAL(20,0)) * CAST(100000 - l_orderkey % 99991 AS DECIMAL(6,0)) * CAST(0.0000000001 AS DECIMAL(10,10)), 2) AS DOUBLE) AS amount
        FROM lineitem""",
    "high_price_flag": v.sales_sql(
        """SELECT category, CAST(CASE WHEN unit_price > 50000 THEN 1 ELSE 0 END AS BIGINT) AS high_price_flag,
        count(*) AS n FROM priced GROUP BY 1, 2"""
    ),
    "profile_columns": v.sales_sql(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, count(*) AS n_rows FROM priced"
            for c, t in SALES_COLUMNS.items()
        )
    ),
    "describe_numeric": v.sales_sql(
        _each(
            MEASURES,
            """SELECT '{c}' AS "column", count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 9) AS mean,
            round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3, CAST(max({c}) AS DOUBLE) AS max FROM priced""",
        )
    ),
    "null_counts": v.sales_sql(_each(SALES_COLUMNS, _NULLS + "priced")),
    "coercion_nulls": v.sales_sql(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", 'string' AS type_before, '{t}' AS type_after, "
            f"(SELECT count(*) FILTER ({c} IS NULL) FROM typed) - "
            f"(SELECT count(*) FILTER ({c} IS NULL) FROM sales_raw) AS nulls_added"
            for c, t in {**SALES_COLUMNS, "quantity": "double"}.items()
        ),
        broken=True,
    ),
    "invalid_to_null": v.sales_sql(
        """SELECT count(*) FILTER (unit_price <= 0) AS invalid_count,
        (SELECT count(*) FILTER (unit_price IS NULL) FROM priced) AS missing_after FROM typed"""
    ),
    "impute_group_median": v.sales_sql("SELECT order_id, category, unit_price FROM filled"),
    "impute_mode": v.sales_sql(f"SELECT coalesce(region, {_MODE}) AS region, count(*) AS n FROM priced GROUP BY 1"),
    "iqr_bounds": v.sales_sql(
        """SELECT "column", round(lower, 6) AS lower, round(upper, 6) AS upper FROM price_bounds
        UNION ALL SELECT "column", round(lower, 6), round(upper, 6) FROM quantity_bounds"""
    ),
    "winsorize": v.sales_sql(
        """SELECT order_id, quantity, round(greatest(p.lower, least(p.upper, unit_price)), 4) AS unit_price
        FROM bounded, price_bounds p"""
    ),
    "winsorize_report": v.sales_sql(
        _REPORT.format(c="unit_price", lo="lower", hi="upper", bounds="price_bounds")
        + " UNION ALL "
        + _REPORT.format(c="quantity", lo="ceil(lower)", hi="floor(upper)", bounds="quantity_bounds")
    ),
    "missing_changes": v.sales_sql(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", b AS nulls_before, a AS nulls_after, b - a AS handled FROM ("
            f"SELECT count(*) FILTER ({c} IS NULL) AS b, "
            + (
                f"count(*) FILTER (coalesce(region, {_MODE}) IS NULL) AS a FROM priced)"
                if c == "region"
                else f"(SELECT count(*) FILTER ({c} IS NULL) FROM filled) AS a FROM priced)"
            )
            for c in SALES_COLUMNS
        )
    ),
    "clean_sales": v.sales_sql("SELECT order_id, category, quantity, unit_price, discount, amount FROM cleaned"),
    "category_summary": v.sales_sql(
        f"""SELECT category, count(unit_price) AS n, round({_MEAN_PRICE}, 1) AS mean_price,
        round(median(unit_price), 1) AS median_price, round({_SUM_AMOUNT}, 1)::DOUBLE AS total_amount
        FROM cleaned WHERE category IS NOT NULL GROUP BY 1"""
    ),
    "top_categories": v.sales_sql(f"{_NUMBERED} FROM ({_TOP}) ORDER BY amount DESC, category LIMIT 3"),
    "sales_kpi": v.sales_sql(f"SELECT {_KPI} FROM cleaned"),
    "sales_pivot": v.sales_sql(
        f"SELECT category, {_PIVOT_CELLS} FROM cleaned WHERE region IS NOT NULL AND category IS NOT NULL GROUP BY 1"
    ),
    "sales_report": v.sales_sql(
        f"""SELECT CAST(0 AS BIGINT) AS rank, 'total' AS category, total_sales AS amount, orders, mean_order
        FROM (SELECT {_KPI} FROM cleaned)
        UNION ALL SELECT rank, category, amount, NULL, NULL FROM ({_NUMBERED} FROM ({_TOP})) WHERE rank <= 10"""
    ),
    "lookup_labels": v.sales_sql(
        """SELECT category, label, CASE WHEN label IS NULL THEN 'left_only' ELSE 'both' END AS _merge, count(*) AS n
        FROM sales_raw LEFT JOIN (VALUES ('ECONOMY', 'economy goods'), ('SMALL', 'small goods'),
            ('LARGE', 'large goods'), ('PROMO', 'promotion')) t(c, label) ON category = c GROUP BY 1, 2, 3"""
    ),
    "lookup_join": _LOOKUP,
    "lookup_join_counts": f"""SELECT (SELECT count(*) FROM customer) AS rows_before, count(*) AS rows_after,
        count(*) FILTER (_merge = 'both') AS both, count(*) FILTER (_merge = 'left_only') AS left_only FROM ({_LOOKUP})""",
}
