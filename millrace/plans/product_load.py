"""Validate records, store the valid and the invalid ones, count everything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.validation import Contract
from millrace.sources.tables import write_csv, write_json, write_parquet


def etl_summary(tagged: DataFrame, saved: DataFrame) -> DataFrame:
    bad = F.size("errors") > 0
    return tagged.agg(
        F.count("*").alias("total"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("invalid")
    ).withColumn("rows_saved", saved.agg(F.count("*").alias("c")).scalar())


def store_valid(tagged: DataFrame, contract: Contract, folder: str, position: str) -> DataFrame:
    """Store the valid rows as Parquet and, their flat columns, as CSV; count rows and both copies."""
    valid = contract.valid(tagged)
    flat = [c for c, kind in valid.dtypes if not kind.startswith(("array", "map", "struct"))]
    write_parquet(valid, f"{folder}/valid")
    write_csv(valid.select(flat), f"{folder}/valid_csv")
    write_json(contract.invalid(tagged, position), f"{folder}/invalid")
    spark = tagged.sparkSession
    copy = spark.read.csv(f"{folder}/valid_csv", header=True, schema=", ".join(f"`{c}` string" for c in flat), escape='"')
    counted = etl_summary(tagged, spark.read.schema(valid.schema).parquet(f"{folder}/valid"))
    return counted.withColumn("csv_rows_saved", copy.agg(F.count("*").alias("c")).scalar())
