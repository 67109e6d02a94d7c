"""Token counts as rollups that signed changes keep up to date.

A store is a folder with three kinds of data, all below one path in shared storage:

* ``ledger/batch=ID/attempt=...``: the signed entries of a batch; what a document counts for now is the sum of its entries.
  Entries lie in ``BUCKETS`` partitions by a hash of doc_id, and a commit reads those that its batch touches;
* ``rollup/batch=ID/attempt=...``: those entries added up by source, lang and version;
* ``commits/ID``: a marker written last, which names the attempt that counts. Only marked batches count.

Committing a batch id again changes nothing; a batch that died before its marker left an attempt that nothing
names. The marker is created only if there is none, so of two commits of one id at a time one wins and the other
changes nothing. Totals are sums over the marked batches' rollups, so they
cost a read of small rows however large the corpus has become.

Changes have (doc_id, op, source, lang, version, tokens). ``insert`` adds a count,
``revise`` first takes back what the ledger holds for the document and version, then
adds; ``delete`` takes it back. Taking back works on the ledger, so a delete needs no
count of its own, and one of an unknown document does nothing. An insert of a document the ledger holds is a
revision. Rows of one batch that repeat a doc_id and version are documents of their own and count each; later
batches revise or delete them together. If a batch both inserts and revises a document, its revisions count; if
it inserts and deletes one, the inserts do. Inserted rows without a doc_id are always new documents; a revision or
deletion without one means all of them. A null source,
lang or version is a value of its own; null tokens count 0. Empty batches commit and
change nothing. Extra columns are ignored.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import stored, table
from millrace.session import scratch_path

BUCKETS = 64

KEYS = ("source", "lang", "version")
LEDGER = "doc_id bigint, source string, lang string, version string, tokens bigint, documents bigint"
ROLLUP = "source string, lang string, version string, tokens bigint, documents bigint"

# tokenizer versions of the registered query: a pattern whose matches are the tokens
VERSIONS = {"words-1": "[^ \\t\\n\\r\\f\\x0B]+", "words-2": "[A-Za-z0-9]+|[^A-Za-z0-9 \\t\\n\\r\\f\\x0B]"}


class RollupStore:
    """Totals of one corpus below ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def committed(self) -> dict[str, str]:
        """Marked batches and the attempt that counts; one short line each."""
        fs, place = self._fs(f"{self.path}/commits")
        if not fs.exists(place):
            return {}
        found = {}
        for status in fs.listStatus(place):
            stream = fs.open(status.getPath())
            try:
                found[status.getPath().getName()] = stream.readUTF()
            finally:
                stream.close()
        return dict(sorted(found.items()))

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{kind}/batch={batch}/attempt={attempt}" for batch, attempt in self.committed().items()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*paths)
        return rows.select(*(c.split()[0] for c in schema.split(", ")))

    def totals(self) -> DataFrame:
        """Tokens and documents by source, lang and version; groups that count nothing are left out."""
        added = self._read("rollup", ROLLUP).groupBy(*KEYS).agg(
            F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents")
        )
        return added.where((F.col("documents") != 0) | (F.col("tokens") != 0))

    def standing(self, buckets: list[int] | None = None) -> DataFrame:
        """What each document counts for now, of all buckets or the given ones."""
        entries = self._read("ledger", LEDGER + ", bucket int")
        if buckets is not None:
            entries = entries.where(F.col("bucket").isin(*buckets))
        summed = entries.groupBy("doc_id", *KEYS).agg(F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents"))
        return summed.where((F.col("documents") != 0) | (F.col("tokens") != 0))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch once; False when it was applied before."""
        if "/" in batch_id or not batch_id:
            raise ValueError("a batch id is one path segment")
        if batch_id in self.committed():
            return False
        rows = changes.select("doc_id", "op", *KEYS, F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))
        rows = stored(rows.where(F.col("op").isin("insert", "revise", "delete")), "changes")
        per_document = rows.groupBy("doc_id", "version").agg(
            F.bool_or(F.col("op") == "revise").alias("revised"), F.bool_and(F.col("op") == "insert").alias("only_inserts")
        )
        known = stored(per_document.withColumn("bucket", bucket_of(F.col("doc_id"))), "touched")
        same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.version").eqNullSafe(F.col(f"{b}.version"))
        added = rows.alias("r").where("op <> 'delete'").join(known.where("revised").alias("k"), same("r", "k"), "left")
        new = added.where((F.col("r.op") == "revise") | F.col("k.revised").isNull()).select(
            "r.doc_id", *(f"r.{k}" for k in KEYS), "r.tokens", F.lit(1).cast("bigint").alias("documents")
        )
        taken = known.where(F.col("doc_id").isNotNull() | ~F.col("only_inserts"))
        buckets = sorted(r["bucket"] for r in taken.select("bucket").distinct().collect())  # at most BUCKETS
        old = self.standing(buckets).alias("s").join(taken.alias("n"), same("s", "n"), "left_semi")
        undone = old.select("doc_id", *KEYS, (-F.col("tokens")).alias("tokens"), (-F.col("documents")).alias("documents"))
        attempt = uuid.uuid4().hex
        ledger = f"{self.path}/ledger/batch={batch_id}/attempt={attempt}"
        entries = new.unionByName(undone).withColumn("bucket", bucket_of(F.col("doc_id")))
        # few files a bucket, and a crowded bucket (rows without an id) over many tasks
        entries.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(ledger)
        self.spark.read.schema(LEDGER).parquet(ledger).groupBy(*KEYS).agg(
            F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents")
        ).write.parquet(f"{self.path}/rollup/batch={batch_id}/attempt={attempt}")
        return self._mark(batch_id, attempt)

    def _mark(self, batch_id: str, attempt: str) -> bool:
        fs, place = self._fs(f"{self.path}/commits/{batch_id}")
        try:
            stream = fs.create(place, False)
        except Py4JJavaError:
            if fs.exists(place):  # another commit of this id was faster
                return False
            raise
        stream.writeUTF(attempt)
        stream.close()
        return True


def bucket_of(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(BUCKETS)).cast("int")


def counted(documents: DataFrame, version: str, pattern: str, op: str) -> DataFrame:
    """Changes that state the token count of each whole text under one version."""
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(pattern)).cast("bigint")
    return documents.select("doc_id", F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("version"), tokens.alias("tokens"))


def op9_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus loaded under two versions, its toxic documents withdrawn, its poor ones recounted without
    punctuation, and every batch delivered twice."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    poor = labels.where("quality = 0 and toxic = 0").select("doc_id").distinct()
    loads = [counted(documents, version, pattern, "insert") for version, pattern in VERSIONS.items()]
    gone = toxic.select(
        "doc_id",
        F.lit("delete").alias("op"),
        F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias("lang"),
        F.explode(F.array(*map(F.lit, VERSIONS))).alias("version"),
        F.lit(0).cast("bigint").alias("tokens"),
    )
    store = RollupStore(spark, scratch_path(spark, "rollups"))
    batches = {
        "000-load": loads[0].unionByName(loads[1]),
        "001-withdraw": gone,
        # counted before the join, so that it shuffles no text
        "002-recount": counted(documents, "words-2", "[A-Za-z0-9]+", "revise").join(poor, "doc_id", "left_semi"),
    }
    for _ in range(2):
        for batch_id, changes in batches.items():
            store.commit(batch_id, changes)
    return store.totals()


ORACLE_SQL = r"""
WITH kept AS (
    SELECT d.*, l.poor FROM documents d
    LEFT JOIN (SELECT doc_id, bool_or(toxic = 1) AS toxic, bool_or(quality = 0 AND toxic = 0) AS poor
               FROM labels GROUP BY 1) l USING (doc_id)
    WHERE NOT coalesce(l.toxic, false)),
counts AS (
    SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(text, '[^ \t\n\r\f\x0B]+')) AS n FROM kept
    UNION ALL
    SELECT source, lang, 'words-2', CASE WHEN poor THEN len(regexp_extract_all(text, '[A-Za-z0-9]+'))
        ELSE len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\f\x0B]')) END FROM kept)
SELECT source, lang, version, CAST(sum(n) AS BIGINT) AS tokens, count(*) AS documents FROM counts GROUP BY ALL
"""
