"""Registered queries on files: tables written as CSV, JSON and text, read back by the library's readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.models import churn
from millrace.operators import cleaning
from millrace.operators.contracts import WEB_LOG
from millrace.session import require_columns, require_rows, scratch_path
from millrace.sources import tables
from millrace.workload import views as v

TEXTS = ("event_id", "ip", "timestamp", "method", "path", "status", "bytes", "user_agent")


def csv_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Raw log texts through CSV, blanks and missing fields included, numbered in file order."""
    folder = scratch_path(spark, "logs-csv")
    raw = v.raw_logs(spark, sf).select(*TEXTS)
    tables.write_csv(raw.repartitionByRange("event_id").sortWithinPartitions("event_id"), folder)
    back = tables.number_rows(tables.read_csv_texts(spark, folder))
    return back.withColumn("event_id", F.col("event_id").cast("bigint"))


def csv_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents through CSV: quotes, commas and line breaks inside fields, files still split."""
    folder = scratch_path(spark, "documents-csv")
    rows = v.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text", "source")
    tables.write_csv(rows, folder)
    back = tables.read_csv_texts(spark, folder, rows.schema, line_breaks=True)
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", F.char_length("text").cast("bigint").alias("n_chars"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
    )


def csv_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers through CSV into typed columns, checked for their columns, their target and missing values."""
    folder = scratch_path(spark, "customers-csv")
    tables.write_csv(v.customers(spark, sf), folder)
    customers = tables.read_churn(spark, folder)
    require_columns(customers, list(tables.CHURN_TYPES))
    require_rows(customers, "the customer table")
    rows = churn.model_rows(customers)
    return cleaning.require_complete(rows, ["customer_id", "contract", "churn"])


def csv_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events through CSV into typed columns; some amounts are texts for a missing value."""
    folder = scratch_path(spark, "events-csv")
    amount = F.when(F.col("event_id") % 7 == 0, "NA").when(F.col("event_id") % 11 == 0, "").otherwise(F.col("value").cast("string"))
    events = v.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", amount.alias("amount"), "props")
    tables.write_csv(events, folder)
    return tables.read_events(spark, folder)


def json_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Invalid log rows stored as JSON and read back, one row per error."""
    folder = scratch_path(spark, "quarantine-json")
    invalid = WEB_LOG.invalid(WEB_LOG.tag(v.raw_logs(spark, sf), "event_id"), "event_id")
    tables.write_json(invalid, folder)
    back = spark.read.schema(invalid.schema).json(folder)
    return back.select(F.col("row_no").alias("event_id"), F.explode("errors").alias("e")).select("event_id", "e.loc", "e.type")


def json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """JSON response files, a document each, cut into the records of their arrays."""
    folder = scratch_path(spark, "responses")
    v.api_documents(spark, sf).select("document").write.option("maxRecordsPerFile", 1).text(folder)
    return tables.read_api_users(spark, folder).select(F.col("id").cast("bigint").alias("id"), "position", "username", "email", "signup_date")


QUERIES = {
    "csv_logs": csv_logs,
    "csv_documents": csv_documents,
    "csv_customers": csv_customers,
    "csv_events": csv_events,
    "json_quarantine": json_quarantine,
    "json_documents": json_documents,
}
ORACLES = {
    "csv_logs": v.raw_log_sql("SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_no, * FROM raw_logs"),
    "csv_documents": """SELECT doc_id, lang, source, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS text_md5
        FROM documents""",
    "csv_customers": v.customer_sql(
        """SELECT CAST(customer_id AS VARCHAR) AS customer_id, senior, tenure_months, monthly_charges, total_charges, num_services,
        gender, contract, payment_method, churn FROM customers"""
    ),
    "csv_events": """SELECT event_id, user_id, event_type, ts,
        CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN value END AS amount FROM events""",
    "json_quarantine": v.raw_log_sql("SELECT event_id, loc, type FROM log_errors"),
    "json_documents": v.user_sql(
        f"""SELECT id, row_number() OVER (PARTITION BY id // {v.PAGE_SIZE} ORDER BY id) - 1 AS position, username, email, signup_date
        FROM users"""
    ),
}
