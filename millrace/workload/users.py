"""Registered queries on nested API users and on part categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import validation
from millrace.operators.contracts import API_USER
from millrace.plans import product_load
from millrace.session import materialize, scratch_path
from millrace.workload import views as v


def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    return API_USER.tag(v.api_users(spark, sf), "row_no")


def json_records(spark: SparkSession, sf: str) -> DataFrame:
    return v.api_users(spark, sf).select("row_no", "id", "username", "email", F.col("profile.country").alias("country"))


def validate_email(spark: SparkSession, sf: str) -> DataFrame:
    """The normalised address, NULL when it is missing or invalid."""
    users = v.api_users(spark, sf)
    return users.select("row_no", validation.EMAIL.parse(F.col("email")).alias("email"))


def validate_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of the nested profile, and the tags with their default."""
    fields = [f for f in API_USER.fields if f.path.startswith("profile") or f.path == "tags"]
    tagged = validation.Contract(fields).tag(v.api_users(spark, sf), "row_no")
    return tagged.select(
        "row_no",
        F.coalesce(F.get("errors", F.lit(0))["loc"], F.lit("-")).alias("loc"),
        F.coalesce(F.get("errors", F.lit(0))["type"], F.lit("-")).alias("type"),
        F.size(fields[-1].value()).cast("long").alias("n_tags"),
    )


def validation_split(spark: SparkSession, sf: str) -> DataFrame:
    return validation.split_counts(_tagged(spark, sf))


def validation_errors(spark: SparkSession, sf: str) -> DataFrame:
    invalid = API_USER.invalid(_tagged(spark, sf), "row_no")
    return validation.error_listing(invalid).select("row_number", "id", "field", "type")


def valid_users(spark: SparkSession, sf: str) -> DataFrame:
    return API_USER.valid(_tagged(spark, sf)).select(
        "id", "username", "email", "age", "is_active", "signup_date",
        F.col("profile.country").alias("country"), F.col("profile.score").alias("score"),
        F.size("tags").cast("long").alias("n_tags"),
    )


# --- stored users and categories -----------------------------------------


def normalize_category(spark: SparkSession, sf: str) -> DataFrame:
    """Part types as categories, given with stray white space and capitals."""
    raw = v.table(spark, sf, "part").select(F.concat(F.lit("\t "), "p_type", F.lit("\n")).alias("category"), "p_size")
    return raw.groupBy(validation.LOWERED.parse(F.col("category")).alias("category")).agg(
        F.count("*").alias("n"), F.sum("p_size").cast("long").alias("size")
    )


def etl_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Users validated, the valid ones stored twice, and everything counted."""
    tagged = materialize(_tagged(spark, sf), "tagged")
    return product_load.store_valid(tagged, API_USER, scratch_path(spark, "users"), "row_no")


QUERIES = {
    "json_records": json_records,
    "validate_email": validate_email,
    "validate_nested": validate_nested,
    "validation_split": validation_split,
    "validation_errors": validation_errors,
    "valid_users": valid_users,
    "normalize_category": normalize_category,
    "etl_summary": etl_summary,
}

ORACLES = {
    "json_records": v.user_sql(
        """SELECT row_no, CAST(id AS VARCHAR) AS id, username, email,
        CASE WHEN has_profile THEN country END AS country FROM users"""
    ),
    "validate_email": v.user_sql(
        r"""SELECT row_no, CASE WHEN regexp_full_match(trim(email), '[^@]+@.*[.].*') THEN lower(trim(email)) END AS email
        FROM users"""
    ),
    "validate_nested": v.user_sql(
        """SELECT u.row_no, coalesce(e.field, '-') AS loc, coalesce(e.type, '-') AS type,
        CAST(CASE WHEN has_tags THEN 1 ELSE 0 END AS BIGINT) AS n_tags
        FROM users u LEFT JOIN (SELECT * FROM user_errors WHERE field LIKE 'profile%') e ON u.row_no = e.row_no"""
    ),
    "validation_split": v.user_sql(
        """SELECT total, total - invalid AS valid, invalid FROM (SELECT count(*) AS total FROM users),
        (SELECT count(DISTINCT row_no) AS invalid FROM user_errors)"""
    ),
    "validation_errors": v.user_sql(
        "SELECT row_no + 1 AS row_number, CAST(id AS VARCHAR) AS id, field, type FROM user_errors"
    ),
    "valid_users": v.user_sql(
        """SELECT id, username, lower(trim(email)) AS email, CAST(age AS BIGINT) AS age, is_active = 'true' AS is_active,
        CAST(signup_date AS DATE) AS signup_date, country, CAST(score AS DOUBLE) AS score,
        CAST(CASE WHEN has_tags THEN 1 ELSE 0 END AS BIGINT) AS n_tags
        FROM users WHERE row_no NOT IN (SELECT row_no FROM user_errors)"""
    ),
    "normalize_category": """SELECT lower(trim(p_type)) AS category, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size
        FROM part GROUP BY 1""",
    "etl_summary": v.user_sql(
        """SELECT total, total - invalid AS valid, invalid, total - invalid AS rows_saved, total - invalid AS csv_rows_saved
        FROM (SELECT count(*) AS total FROM users), (SELECT count(DISTINCT row_no) AS invalid FROM user_errors)"""
    ),
}
