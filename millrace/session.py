"""Session set-up and shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# temporary folders of local sessions without spark.checkpoint.dir, by application
_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(master: str, shuffle_partitions: int, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks; on a cluster use the one you are given."""
    return (
        SparkSession.builder.master(master)
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh folder below ``spark.checkpoint.dir``, which all executors must share.

    Only a local session without that setting gets a temporary folder, which stays with this module: the
    setting cannot be changed in a running session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="millrace-")
        base = _LOCAL_FOLDERS[application]
    return f"{_own_folder(spark, base)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and read it back: one evaluation, no lineage to replay.

    With ``partition_by`` (columns of few values) filters on these columns read only their part.
    """
    path = scratch_path(df.sparkSession, label)
    if not partition_by:
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def attach(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join a per-key table to many rows.

    The lookup is stored first, so it is computed once and Spark knows its size in bytes
    when it chooses between a broadcast and a shuffle. Nothing passes through the driver.
    """
    return rows.join(materialize(lookup, "lookup"), list(keys), how)


def delete_stored(df: DataFrame) -> None:
    """Delete the tables of ``materialize`` that ``df`` reads; whatever still reads them fails."""
    spark = df.sparkSession
    jvm, own = spark.sparkContext._jvm, _own_folder(spark, "") + "/"
    for folder in {f[: f.find("/", f.find(own) + len(own))] if own in f else "" for f in df.inputFiles()}:
        if not folder:
            raise ValueError("only what this application has stored is deleted")
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has stored; results that read it are gone with it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_FOLDERS.pop(spark.sparkContext.applicationId, None)
    if base:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark, base))
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _own_folder(spark: SparkSession, base: str) -> str:
    return f"{base.rstrip('/')}/millrace/{spark.sparkContext.applicationId}"


def require_columns(df: DataFrame, needed: Sequence[str]) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError("required columns are missing: " + ", ".join(missing))


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
