"""Readers with explicit schemas, and sinks."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import blank_to_null, to_number
from millrace.operators.contracts import API_RESPONSE_TEXTS, WEB_LOG_TEXTS, texts
from millrace.operators.lookup import same_rows
from millrace.session import attach, require_columns, require_rows
from millrace.sources.split_text import csv_records, json_records

# The columns of the input files and their types.
SALES_TEXTS = texts("order_id", "order_date", "region", "category", "quantity", "unit_price", "discount")
EVENT_TYPES = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "ts": "timestamp_ntz", "amount": "double"}
CHURN_TYPES = {
    "customer_id": "string", "gender": "string", "senior": "int", "tenure_months": "int",
    "monthly_charges": "double", "total_charges": "double", "contract": "string",
    "payment_method": "string", "num_services": "int", "churn": "int",
}
NUMBERS = ("int", "bigint", "double")
# text forms of times with all their digits
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, from its first line only."""
    line = spark.read.text(path).limit(1).first()
    if line is None:
        raise ValueError(f"{path} is empty")
    return [name.strip() for name in next(csv.reader([line[0].lstrip("\ufeff")]))]


def read_csv_texts(
    spark: SparkSession, path: str, schema: T.StructType | None = None, line_breaks: bool = False
) -> DataFrame:
    """CSV with a header, every column text; files are split, nothing is inferred.

    A quote inside a quoted field is doubled. ``line_breaks`` allows line breaks inside
    quoted fields; files are split then too, but read twice, see ``split_text``.
    """
    schema = schema or texts(*header_of(spark, path))
    if line_breaks:
        return parsed_records(csv_records(spark, path), schema)
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False, quote='"', escape='"')


def parsed_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of CSV records; the header and blank records are left out."""
    body = records.where(((F.col("block") > 0) | (F.col("number") > 0)) & (F.col("text") != ""))
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}
    return body.select(F.from_csv("text", schema.toDDL(), options).alias("r")).select("r.*")


def read_csv_typed(
    spark: SparkSession, path: str, types: dict[str, str], line_breaks: bool = False
) -> DataFrame:
    """CSV with a header as typed columns; texts for a missing value become NULL."""
    names = header_of(spark, path)
    missing = sorted(set(types) - set(names))
    if missing:
        raise ValueError("required columns are missing: " + ", ".join(missing))
    raw = read_csv_texts(spark, path, texts(*names), line_breaks)
    columns = []
    for name, kind in types.items():
        value = blank_to_null(F.col(name))
        columns.append((to_number(value, kind) if kind in NUMBERS else value.cast(kind)).alias(name))
    return raw.select(columns)


def read_web_logs(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_texts(spark, path, WEB_LOG_TEXTS)


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """Raw sales as texts with missing values as NULL, ready for coercion."""
    raw = read_csv_texts(spark, path, SALES_TEXTS)
    return raw.select(*[blank_to_null(F.col(c)).alias(c) for c in raw.columns])


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_typed(spark, path, EVENT_TYPES)


def read_churn(spark: SparkSession, path: str) -> DataFrame:
    customers = read_csv_typed(spark, path, CHURN_TYPES)
    require_columns(customers, list(CHURN_TYPES))
    require_rows(customers, "the customer table")
    return customers


def read_api_users(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON response documents with their 0-based ``position``; a document is read by as many tasks as
    it has blocks."""
    record = API_RESPONSE_TEXTS["results"].dataType.elementType
    parsed = json_records(spark, path).select("position", F.from_json("text", record).alias("r"))
    return parsed.select("position", "r.*")


def explode_results(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return documents.select(*keep, F.posexplode("results").alias("position", "r")).select(
        *keep, F.col("position").cast("long").alias("position"), "r.*"
    )


def number_rows(df: DataFrame, name: str = "row_no") -> DataFrame:
    """Add the 0-based position of each row of a file scan, in file order.

    Files are ordered by path. Rows are counted per file and block; a row's position is
    the number of rows in the blocks before its own plus its place inside it. The table of
    blocks is stored and joined; its running sum is over one row per block.
    """
    block = ["_file", "_block"]
    marked = df.select(
        "*",
        F.input_file_name().alias("_file"),
        F.input_file_block_start().alias("_block"),
        F.monotonically_increasing_id().alias("_mark"),
    )
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(*block)
        .agg(F.count("*").alias("_rows"), F.min("_mark").alias("_first"))
        .select(*block, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    joined = attach(marked, offsets, block, "inner")
    return joined.select(*df.columns, (F.col("_offset") + F.col("_mark") - F.col("_first")).alias(name))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Blanks at the ends of texts stay; a missing value is an empty field, an empty text a quoted one."""
    df.write.mode(mode).options(**TIMES).csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**TIMES).json(path)


def write_verified(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write Parquet, read it back, fail when the rows differ; return the stored table."""
    write_parquet(df, path, mode)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    if not same_rows(df, stored):
        raise ValueError(f"{PurePosixPath(path).name} differs from what was written")
    return stored
