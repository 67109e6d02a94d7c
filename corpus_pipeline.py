"""The corpus pipeline: five stages, each a DataFrame job over what the stage before kept.

Stages take (spark, docs, sf_dir), with docs in the shape of ``documents`` and the other
tables below sf_dir, and return a DataFrame. All but the last return the columns of their
input. The toxicity and mixing models are fitted on labelled rows that are still there.

Rows are whole texts, so the job lowers an Arrow batch to ``BATCH_ROWS`` rows and ``BATCH_BYTES``: Spark's defaults of 10,000
and 64 MB make batches of tens of MB, which each task slot holds in the executor and again in Python. Buffers of a few MB come
from Arrow's pool and go back to it; larger ones are taken from the system one by one, and a long-lived executor keeps what
they leave. Batches end with the row that reaches the limit: no row is cut, and a smaller setting stays.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, mixing, near_dedup, sentencepiece, toxicity
from millrace.llm.common import stored, table

# token shares of clean and poor text; toxic text was removed before and gets no share of its own
MIX = {"clean": 0.95, "junk": 0.05, "toxic": 0.0}
BATCH_ROWS, BATCH_BYTES = 2000, 1 << 20


def bytes_of(setting: str) -> int:
    """Bytes of a size as Spark's settings give it: 67108864, 67108864b, 64m, 64MB."""
    number, unit = re.fullmatch(r"(-?\d+)([bkmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def small_batches(spark: SparkSession) -> None:
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:  # 0 or less: no limit
        spark.conf.set(rows, str(BATCH_ROWS))
    if not 0 < bytes_of(spark.conf.get(size)) <= BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_dedup.deduplicated(docs, size=5, percent=80)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.resampled(docs, table(spark, sf_dir, "labels"), weights=MIX)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return sentencepiece.encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_domains),
    ("sentencepiece", encode_pieces),
]

# trained models and subword pieces are no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
