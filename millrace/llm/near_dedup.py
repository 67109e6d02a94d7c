"""MinHash near-duplicates: banded candidates, sequential Bayesian verification, exact check.

A document's set holds 64-bit hashes of its distinct word shingles. Documents with equal
sets form a class; one row stands for it. Standing rows get a signature of ``PLACES``
minima, in ``PLACES / ROWS`` bands. Rows with a band in common are candidates:

* each is first paired with the smallest row of the band (a star, never all pairs);
* verified links give components; only in bands that still hold rows of several components are
  pairs across components compared, block by block inside tasks that hold these rows'
  signatures and texts. A task writes one link per row and foreign component, which is all that
  joining them takes: no link between components is lost and no bucket's pairs are written out.

Joins that carry signatures or texts are always sorted merges, whatever the size.

A candidate pair is verified by reading the signatures ``BATCH`` places at a time. With a
uniform prior the posterior of the similarity after m of n agreements is Beta(m + 1,
n - m + 1); the pair is dropped as soon as its probability of reaching the threshold is below
``MISS``. Survivors are verified exactly on the full shingle sets, rebuilt from whole
texts. The chance that a pair at the threshold shares no band is ``(1 - t^ROWS)^(PLACES/ROWS)``,
2e-6 with the defaults at 0.8.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A text with fewer words than a
shingle is one shingle; null, empty and blank texts have none and link with nothing. A
null doc_id is compared like any other row and is the smallest id only of a component without
other ids. Repeated rows are linked. An empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import (
    WordHashes,
    discarded,
    fewer,
    hashed_words,
    keep_rows,
    mark,
    minhash,
    permutations,
    shingles,
    shortened,
    slices,
    stored,
    table,
    utf8,
)
from millrace.llm.components import components

ROWS, PLACES, BATCH = 6, 240, 24
MISS = 1e-6
SEED = 91
BLOCK = 2048  # rows of a mixed band that meet another block's in one task


def word_set(body: bytes, size: int, known: WordHashes) -> np.ndarray:
    return shingles(hashed_words(body.lower().split(), known), size)


def least_agreements(similarity: float, miss: float = MISS, places: int = PLACES, batch: int = BATCH) -> list[tuple[int, int]]:
    """After n places, the fewest agreements with which a pair stays: P(J >= t | m of n) >= miss.

    The tail of Beta(m + 1, n - m + 1) above t is the probability of at most m successes
    in n + 1 trials with chance t.
    """
    bounds = []
    for n in range(batch, places + 1, batch):
        tail = 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
            if tail >= miss:
                bounds.append((n, m))
                break
    return bounds


def stays(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs of signatures outlast every batch; later batches read only those still in."""
    alive = np.arange(len(left))
    agreed = np.zeros(len(left), dtype=np.int32)
    done = 0
    for n, least in bounds:
        if not len(alive):
            break
        agreed[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        alive = alive[agreed[alive] >= least]
        done = n
    out = np.zeros(len(left), dtype=bool)
    out[alive] = True
    return out


_SHINGLED = "doc_id bigint, mark bigint, row bigint, n_shingles bigint, digest binary, signature binary, body binary"


def shingled(documents: DataFrame, size: int) -> DataFrame:
    """Set size, digest of the set, signature and the packed text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        known, pack = WordHashes(), zstandard.ZstdCompressor(level=3)
        a, b = permutations(PLACES, SEED)
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "body"):
            counts, digests, signatures, bodies = [], [], [], []
            for body in batch.column("body").to_pylist():
                items = word_set(body, size, known)
                mins = minhash(items, a, b)
                counts.append(len(items))
                digests.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                signatures.append(shortened(mins).tobytes())
                bodies.append(pack.compress(body))
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("mark"),
                    pa.array(np.arange(row, row + n)),
                    pa.array(counts, type=pa.int64()),
                    pa.array(digests, type=pa.binary()),
                    pa.array(signatures, type=pa.binary()),
                    pa.array(bodies, type=pa.binary()),
                ],
                names=[x.split()[0] for x in _SHINGLED.split(", ")],
            )
            row += n

    keyed = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), mark().alias("mark"), utf8().alias("body"))
    return keyed.mapInArrow(run, _SHINGLED)


def band_keys(signature: Column, places: int = PLACES, rows: int = ROWS) -> Column:
    """One 64-bit key per band of ``rows`` places (two bytes each)."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(places // rows - 1)),
        lambda i: F.xxhash64(i, F.substring(signature, i * (2 * rows) + 1, F.lit(2 * rows))),
    )


def beside(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Shuffled join of two sides that grow with the input; hot keys are split at run time."""
    return left.join(right.hint("merge"), on, how)


def with_both(pairs: DataFrame, rows: DataFrame, column: str, count: int) -> DataFrame:
    """The pairs (a, b) with ``left`` and ``right``, the column of their rows; ``count`` rows are searched in all."""
    joined = fewer(beside(pairs, rows.select(F.col("row").alias("a"), F.col(column).alias("left")), "a"), count)
    return fewer(beside(joined, rows.select(F.col("row").alias("b"), F.col(column).alias("right")), "b"), count)


def plausible(pairs: DataFrame, signatures: DataFrame, similarity: float, count: int, places: int = PLACES) -> DataFrame:
    """The pairs (a, b) whose signatures pass the Bayesian bounds."""
    bounds = least_agreements(similarity, places=places)
    joined = with_both(pairs, signatures, "signature", count)

    @F.pandas_udf("boolean")
    def passes(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for i in range(0, len(left), 4096):
            x, y = (np.frombuffer(b"".join(s.iloc[i : i + 4096]), dtype=np.uint16).reshape(-1, places) for s in (left, right))
            out.append(stays(x, y, bounds))
        return pd.Series(np.concatenate(out) if out else np.zeros(0, dtype=bool))

    return joined.where(passes("left", "right")).select("a", "b")


def linked(pairs: DataFrame, texts: DataFrame, size: int, percent: int, count: int) -> DataFrame:
    """The pairs with 100 * common >= percent * union on full sets."""
    joined = with_both(pairs, texts, "body", count)

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        import zstandard

        unpack, known, last, kept = zstandard.ZstdDecompressor(), WordHashes(), None, None
        out = []
        for x, y in zip(left, right):
            if y != last:
                last, kept = y, word_set(unpack.decompress(y), size, known)
            items = word_set(unpack.decompress(x), size, known)
            common = len(np.intersect1d(items, kept, assume_unique=True))
            out.append(100 * common >= percent * (len(items) + len(kept) - common))
        return pd.Series(out, dtype=bool)

    return joined.where(similar("left", "right")).select("a", "b")


def first_common(left: np.ndarray, right: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Number of the first band that each pair of signatures shares."""
    whole = left.shape[1] // rows * rows
    return (left == right)[:, :whole].reshape(len(left), -1, rows).all(axis=2).argmax(axis=1)


def across(members: DataFrame, size: int, percent: int, places: int = PLACES, per_band: int = ROWS) -> DataFrame:
    """Links (a, b) between different labels of one mixed band, found and checked inside tasks.

    ``members`` has band, number (of the band in the signature), n (rows of the band), row,
    label, signature and body. A band of over ``BLOCK`` rows is cut into blocks by a hash, and every two
    blocks meet in a task of their own. A pair that shares several bands is checked in the first.
    """
    bounds = least_agreements(percent / 100, places=places)
    placed = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    )
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "low", F.least("block", "other")
    ).withColumn("high", F.greatest("block", "other"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        unpack, known, sets = zstandard.ZstdDecompressor(), WordHashes(), {}
        group = group.drop_duplicates("row")
        rows, labels, bodies = group["row"].tolist(), group["label"].to_numpy(), group["body"].tolist()
        number = group["number"].iloc[0]
        signatures = np.frombuffer(b"".join(group["signature"]), dtype=np.uint16).reshape(-1, places)

        def items(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = word_set(unpack.decompress(bodies[i]), size, known)
            return sets[i]

        found = []
        for i in range(len(rows) - 1):
            others = np.flatnonzero(labels[i + 1 :] != labels[i]) + i + 1
            left = np.broadcast_to(signatures[i], (len(others), places))
            others = others[stays(left, signatures[others], bounds)]
            if not len(others):
                continue
            left = np.broadcast_to(signatures[i], (len(others), places))
            others = others[first_common(left, signatures[others], per_band) == number]
            # most alike first: the first link to a label settles it
            agreed = (signatures[others] == signatures[i]).sum(axis=1)
            settled = set()
            for j in others[np.argsort(-agreed, kind="stable")].tolist():
                if labels[j] in settled:
                    continue
                common = len(np.intersect1d(items(i), items(j), assume_unique=True))
                if 100 * common >= percent * (len(items(i)) + len(items(j)) - common):
                    settled.add(labels[j])
                    found.append((max(rows[i], rows[j]), min(rows[i], rows[j])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    needed = met.select("band", "low", "high", "number", "row", "label", "signature", "body")
    return needed.groupBy("band", "low", "high").applyInPandas(compare, "a bigint, b bigint")


def search(
    rows: DataFrame,
    size: int,
    percent: int,
    places: int = PLACES,
    per_band: int = ROWS,
    texts: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of equal sets (digest, node, members), links between nodes (a, b) and their components (node, label).

    ``rows`` is stored and has row, n_shingles, digest, signature and body as ``shingled`` gives them; without bodies
    ``texts`` finds (row, body) of the given rows.
    """
    similarity, count = percent / 100, rows.count()
    # equal sets have equal signatures
    grouped = rows.where("n_shingles > 0").groupBy("digest", "signature").agg(F.min("row").alias("row"), F.count("*").alias("members"))
    standing = stored(fewer(grouped, count), "nodes")
    classes, nodes = standing.select("digest", F.col("row").alias("node"), "members"), standing.select("row", "signature")

    bands = nodes.select("row", F.posexplode(band_keys(F.col("signature"), places, per_band)).alias("number", "band"))
    shared = bands.groupBy("band").agg(F.min("row").alias("leader"), F.count("*").alias("n")).where("n > 1")
    held = stored(fewer(beside(bands, shared, "band"), count), "held")  # rows of bands that several rows share
    wanted = held.select("row").distinct()
    found = beside(rows.select("row", "body"), wanted, "row", "left_semi") if texts is None else texts(wanted)
    texts = stored(fewer(found, count), "texts")
    star = fewer(held.where("row <> leader").select(F.col("row").alias("a"), F.col("leader").alias("b")).distinct(), count)
    alike = plausible(star, nodes, similarity, count, places)
    links = stored(linked(alike, texts, size, percent, count), "links")

    labels = components(links)
    labelled = beside(held, labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    # of two rows the star has checked the only pair
    labelled = fewer(labelled.where("n > 2"), count)
    mixed = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    members = beside(labelled.select("band", "number", "n", "row", "label"), mixed.where("low <> high").select("band"), "band")
    members = fewer(beside(beside(fewer(members, count), nodes, "row"), texts, "row"), count)
    fresh = stored(fewer(across(members, size, percent, places, per_band).distinct(), count), "across")
    if not fresh.isEmpty():
        links = links.union(fresh)
        labels = components(links)
    discarded(held, texts)
    return classes, links, labels


def membership(placed: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``placed`` (with row, n_shingles, digest) with node, members and label; rows without shingles are alone."""
    own = [c for c in placed.columns if c != "digest"]
    by_class = beside(placed.where("n_shingles > 0"), classes, "digest").select(*own, "node", "members")
    alone = placed.where("n_shingles = 0").select(*own, F.col("row").alias("node"), F.lit(1).cast("bigint").alias("members"))
    joined = beside(by_class.unionByName(alone), labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return stored(fewer(joined, placed.count()), "membership")


def firsts(joined: DataFrame) -> DataFrame:
    """Per label ``f``: the smallest id, null last, and of repeated rows the first."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    return joined.groupBy("label").agg(F.min(order).alias("f"))


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, mark, n_shingles, component_id and first (the one row of its component that stays)."""
    rows = stored(shingled(documents, size), "shingled")
    classes, _, labels = search(rows, size, percent)
    joined = membership(rows.select("doc_id", "mark", "row", "n_shingles", "digest"), classes, labels)
    discarded(rows, classes)
    return beside(joined, firsts(joined), "label").select(
        "doc_id", "mark", "n_shingles", F.col("f.doc_id").alias("component_id"), (F.col("row") == F.col("f.row")).alias("first")
    )


def deduplicated(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one row of each component."""
    return keep_rows(documents, near_duplicates(documents, size, percent).where("first"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4, percent=80)
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
