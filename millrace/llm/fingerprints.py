"""Document fingerprints: MinHash signatures, likeness, band join and verified pairs.

A text's words are the runs of characters other than ASCII blanks, with A-Z lower-cased;
its items are hashes of five-word shingles (of fewer words, the whole). ``PERMUTATIONS``
universal hash functions give one minimum each, computed in blocks by numpy; the
fingerprint is the lower 16 bits of each minimum in hexadecimal. Likeness of two
fingerprints is the share of equal places, an estimate of the Jaccard similarity.

Near duplicates have a Jaccard similarity of ``SIMILARITY`` or more on full shingle sets. Their
candidates share a band of the signature; ``near_dedup.search`` pairs each band as a star, then compares exactly
what bands still hold of different components. The chance that a pair at the
threshold shares no band is ``(1 - t^BAND_ROWS)^(PERMUTATIONS // BAND_ROWS)``, 5e-5. A
component is named by its smallest doc_id (a null one only without others); ``n_links`` counts a row's verified links.

Texts are shuffled compressed, once, to find the next document; only fingerprints are stored. The texts of rows
that share a band are read again from the documents, past a Bloom filter of these rows.

A null text is empty; texts without words have one fingerprint of their own. Documents
are ordered by (doc_id, hash of the text), null ids first, so ties and repeated rows have a defined
next document. A single document is its own next. An empty table gives an empty result.
Extra columns are ignored. No text is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import (
    TASK_ROWS,
    WordHashes,
    binaries,
    fewer,
    hashed_words,
    mark,
    minhash,
    parallelism,
    permutations,
    shingles,
    shortened,
    slices,
    stored,
    table,
    utf8,
)
from millrace.llm.near_dedup import beside, firsts, membership, search
from millrace.llm.url_filter import bits_of, block_of, bloom

PERMUTATIONS = 128
SHINGLE = 5
SEED = 20240501
SIMILARITY = 0.8
BAND_ROWS = 5
MOST_FILTERED = 8_000_000  # rows the filter is sized for: 18 MB at most; with more of them it lets more texts pass


class Fingerprinter:
    """Signatures of texts; holds the hashes of words met so far."""

    def __init__(self, count: int = PERMUTATIONS, size: int = SHINGLE, seed: int = SEED) -> None:
        self.a, self.b = permutations(count, seed)
        self.size, self.known = size, WordHashes()

    def items(self, text: bytes) -> np.ndarray:
        return shingles(hashed_words(text.lower().split(), self.known), self.size)

    def __call__(self, text: bytes) -> np.ndarray:
        return self.signature(self.items(text))

    def signature(self, items: np.ndarray) -> np.ndarray:
        return shortened(minhash(items, self.a, self.b)).astype(">u2")


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    return float(np.mean(left == right))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_PACKED = "block int, place int, doc_id bigint, mark bigint, body binary"


def with_blocks(documents: DataFrame) -> tuple[DataFrame, int]:
    """Documents dealt to ranges of doc_id, each followed by a copy of the next range's first row, texts compressed; and how many they are.

    The range bounds come from one pass over the ids and number at most eight per shuffle partition, or four per
    ``TASK_ROWS`` rows where these are fewer; nothing else reaches the driver. ``place`` orders a block: own rows, then the
    copied one.
    """
    spark = documents.sparkSession
    wanted = 8 * parallelism(spark)
    shares = [i / wanted for i in range(1, wanted)]
    cuts, count = documents.agg(F.percentile_approx("doc_id", shares, 20_000), F.count("*")).first()
    bounds = np.unique(np.array(cuts or [], dtype=np.int64))
    most = max(8 * spark.sparkContext.defaultParallelism, 4 * -(-count // TASK_ROWS))
    bounds = bounds[:: -(-len(bounds) // most) or 1]

    def blocks(ids: pd.Series) -> np.ndarray:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), dtype=np.int32)
        out[known] = np.searchsorted(bounds, ids[known].astype("int64").to_numpy(), side="right") + 1
        return out

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        return pd.Series(blocks(ids))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches, "body"):
            ids = batch.column("doc_id")
            bodies = binaries([pack.compress(x) for x in batch.column("body").to_pylist()])
            block = pa.array(blocks(ids.to_pandas(integer_object_nulls=True)))
            yield pa.RecordBatch.from_arrays(
                [block, pa.array(np.zeros(len(ids), np.int32)), ids, batch.column("mark"), bodies],
                names=["block", "place", "doc_id", "mark", "body"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), mark().alias("mark"), utf8().alias("body"))
    heads = rows.select("doc_id", block_of("doc_id").alias("block")).groupBy("block").agg(F.min("doc_id").alias("doc_id")).collect()
    heads = sorted((h["block"], h["doc_id"]) for h in heads)  # at most one row per range
    own = rows.mapInArrow(packed, _PACKED)
    copies = []
    for (block, _), (_, first) in zip(heads, heads[1:] + heads[:1]):
        copies.append((block, first))
    if not copies:
        return own, count
    lookup = spark.createDataFrame(copies, "owner int, first bigint")
    first = F.struct("mark", "place", "doc_id", "body")
    found = rows.join(F.broadcast(lookup), F.col("doc_id").eqNullSafe(F.col("first")))
    moved = found.select("owner", F.lit(1).alias("place"), "doc_id", "mark", "body").groupBy("owner").agg(F.min(first).alias("f"))
    zipped = fewer(moved.select("f.doc_id", "f.mark", "f.body", "owner"), len(copies))
    return own.unionByName(zipped.mapInArrow(_repacked, _PACKED)), count


def _repacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The copied rows of the ranges, compressed."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        bodies = binaries([pack.compress(x) for x in batch.column("body").to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [batch.column("owner"), pa.array(np.ones(batch.num_rows, np.int32)), batch.column("doc_id"), batch.column("mark"), bodies],
            names=["block", "place", "doc_id", "mark", "body"],
        )


_PRINTS = (
    "doc_id bigint, n_chars bigint, edited binary, signature binary, edited_signature binary, near_edited double, near_next double"
)
_SEARCHED = ", mark bigint, row bigint, n_shingles bigint, digest binary"
_KINDS = {"bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def signatures(documents: DataFrame, searched: bool = False) -> DataFrame:
    """Signature of every document, of its edited text, and both likenesses. One shuffle of the compressed texts.

    A task of that shuffle takes several ranges, so that tasks and stored files do not outnumber the task slots eightfold. With ``searched`` also what ``near_dedup.search`` reads; store it, as row numbers belong to one evaluation.
    """
    rows, count = with_blocks(documents)
    dealt = fewer(rows.repartition(parallelism(documents.sparkSession), "block"), count).sortWithinPartitions("block", "place", "doc_id", "mark")
    schema = _PRINTS + (_SEARCHED if searched else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        sign, unpack = Fingerprinter(), zstandard.ZstdDecompressor()
        names, kinds = zip(*(x.split() for x in schema.split(", ")))
        row = TaskContext.get().partitionId() << 40
        waiting = None  # (block, doc_id, text, signature, what the search reads) of the row whose successor comes next
        for batch in slices(batches, "body", 2 << 20):
            out = []
            for block, place, doc_id, mark_, packed in zip(*(batch.column(c).to_pylist() for c in ("block", "place", "doc_id", "mark", "body"))):
                body = unpack.decompress(packed)
                items = sign.items(body)
                text, signature = body.decode("utf-8"), sign.signature(items)
                if waiting is not None and waiting[0] == block:
                    changed = edited(waiting[2], text).encode("utf-8")
                    other = sign(changed)
                    out.append(
                        (
                            waiting[1], len(waiting[2]), hashlib.sha256(changed).digest(), waiting[3].tobytes(),
                            other.tobytes(), likeness(waiting[3], other), likeness(waiting[3], signature), *waiting[4],
                        )
                    )
                extra = ()
                if searched and place == 0:
                    extra = (mark_, row, len(items), hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                    row += 1
                waiting = (block, doc_id, text, signature, extra) if place == 0 else None
            if out:
                columns = [pa.array(c, type=_KINDS[kind]) for c, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=list(names))

    return dealt.mapInArrow(run, schema)


def shown(rows: DataFrame, *more: str) -> DataFrame:
    """Fingerprints in hexadecimal."""
    def text(column: str) -> Column:
        return F.lower(F.hex(column))

    return rows.select(
        "doc_id", "n_chars", text("edited").alias("edited_sha256"), text("signature").alias("fingerprint"),
        text("edited_signature").alias("edited_fingerprint"), "near_edited", "near_next", *more,
    )


def fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprint of every document, of its edited text, and both likenesses."""
    return shown(signatures(documents))


def texts_of(documents: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(row, body) of the wanted rows, bodies compressed, read from the documents again.

    A Bloom filter of the wanted rows, with a bounded number of blocks, keeps most other texts out of the shuffle; the
    join on id and hash of the text is exact.
    """
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("mark").cast("string"))
    keys = beside(rows.select("row", "doc_id", "mark"), wanted, "row", "left_semi").select("row", name.alias("listed"))
    count = rows.count()
    keys = stored(fewer(keys, count), "wanted")
    listed = keys.count()
    words, blocks = bloom(keys, min(listed, MOST_FILTERED))
    words = F.broadcast(stored(fewer(words, listed), "bloom"))
    own = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), mark().alias("mark"), utf8().alias("body"))
    named = own.select(name.alias("listed"), "body").withColumn("block", block_of(F.col("listed"), blocks))
    held = F.lit(True)
    for k, bit in enumerate(bits_of(F.col("listed"))):
        held = held & (F.col(f"w{k}").bitwiseAND(bit) != 0)
    passed = named.join(words, "block").where(held).select("listed", "body")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches, "body"):
            bodies = binaries([pack.compress(x) for x in batch.column("body").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("listed"), bodies], names=["listed", "body"])

    joined = beside(passed.mapInArrow(packed, "listed string, body binary"), keys, "listed")
    # repeated rows of a document have one text
    first = Window.partitionBy("listed").orderBy("row")
    return joined.withColumn("k", F.row_number().over(first)).where("k = 1").select("row", "body")


def linked_fingerprints(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``fingerprints`` with component_id and n_links of the verified near duplicates.

    ``n_links`` counts the links that the search has verified and needs to hold a component together, not
    all pairs of it: rows of equal sets have one to the first of them, and it one to each. 0: no near duplicate.
    """
    percent = round(100 * similarity)
    rows = stored(signatures(documents, searched=True), "signatures")
    classes, links, labels = search(
        rows, SHINGLE, percent, PERMUTATIONS, BAND_ROWS, texts=lambda wanted: texts_of(documents, rows, wanted)
    )
    joined = membership(rows.select("doc_id", "row", "n_shingles", "digest"), classes, labels)
    ends = links.select(F.col("a").alias("row")).union(links.select(F.col("b").alias("row"))).groupBy("row").agg(F.count("*").alias("n"))
    equal = F.when(F.col("row") == F.col("node"), F.col("members") - 1).otherwise(1)
    count = rows.count()
    placed = fewer(beside(joined, firsts(joined), "label"), count).select(
        "row", F.col("f.doc_id").alias("component_id"), equal.alias("equal")
    )
    counted = beside(placed, ends, "row", "left").select(
        "row", "component_id", (F.col("equal") + F.coalesce("n", F.lit(0))).alias("n_links")
    )
    return shown(fewer(beside(rows, counted, "row"), count), "component_id", "n_links")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
