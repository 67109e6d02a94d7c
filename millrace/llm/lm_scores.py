"""Stupid-backoff language-model scores of every document under the n-grams of all the others.

Orders 1 to 3. The score of a word after its context is, at the longest order whose n-gram
other documents hold, its count over its context's count; each step down multiplies by
``ALPHA``. A word alone counts over all other words; one that no other document holds
takes one further step down from a count of one. A document's own n-grams are taken off all counts, so a
text does not vouch for itself (exact copies still vouch for each other).

The join is on n-gram hashes, in packed rows, since an exploded row per n-gram would make
the shuffle several times the text:

1. Documents are packed into chunks, stored once; a chunk holds each distinct n-gram once with its count
   there, which pre-aggregates frequent ones: no key is hot, however common.
2. Each chunk's sorted n-gram hashes go, cut by hash range, to count-table partitions. There the counts of all chunks
   are added up and joined back to the n-grams of each chunk, in the order they came in.
3. The counts return to their chunk, where each document's positions look them up, and are
   summed per document.

Hashes have ``KEY_BITS`` bits. What a task holds is one chunk or one hash range; there
are as many ranges as chunks times distinct n-grams need, by the number of stored words.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; n-grams do not cross documents. Null, empty
and blank texts have no words and score 0. Null ids and repeated rows are scored row by
row (a repeated row is another document). An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import WordHashes, hashed_words, mix, parallelism, ragged, slices, stored, table, utf8

ALPHA = 0.4
ORDER = 3
KEY_BITS = 56
CHUNK_BYTES = 12 << 20  # text of a chunk
RANGE_WORDS = 600_000  # words of corpus per hash range


def packed(documents: DataFrame) -> DataFrame:
    """Chunks of whole documents: ids, sizes in bytes, words, and the texts compressed."""
    schema = "chunk bigint, doc_ids array<bigint>, sizes array<int>, n_words bigint, body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        chunk = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def made() -> pa.RecordBatch:
            words = sum(len(t.split()) for t in texts)
            columns = [
                pa.array([chunk]), pa.array([ids], type=pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], type=pa.list_(pa.int32())),
                pa.array([words]), pa.array([pack.compress(b"".join(texts))], type=pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "doc_ids", "sizes", "n_words", "body"])

        for batch in slices(batches, "body", 1 << 20):
            bodies = batch.column("body").to_pylist()
            ids += batch.column("doc_id").to_pylist()
            texts += bodies
            held += sum(map(len, bodies))
            if held >= CHUNK_BYTES:
                yield made()
                ids, texts, held, chunk = [], [], 0, chunk + 1
        if texts:
            yield made()

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("body")).mapInArrow(run, schema)


def chunk_words(body: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a chunk end to end, and the number of words of each document."""
    import zstandard

    text = zstandard.ZstdDecompressor().decompress(body) if len(sizes) else b""
    known, found, at = WordHashes(), [], 0
    for size in sizes.tolist():
        found.append(hashed_words(text[at : at + size].lower().split(), known))
        at += size
    lengths = np.array([len(f) for f in found], dtype=np.int64)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), lengths


def ngram_keys(words: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of each document of a chunk, end to end; none crosses documents."""
    m = max(len(words) - n + 1, 0)
    h = np.full(m, np.uint64(n))
    with np.errstate(over="ignore"):
        for k in range(n):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += words[k : k + m]
        if n > 1:
            inside = np.ones(len(words), dtype=bool)
            for begin in (np.cumsum(lengths) - lengths)[lengths > 0].tolist():
                inside[begin : begin + n - 1] = False
            h = h[inside[n - 1 :]]
        return mix(h) >> np.uint64(64 - KEY_BITS)


def distinct_counted(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all orders with their counts; one order is held at a time."""
    keys, counts = [], []
    for n in range(1, ORDER + 1):
        found = ngram_keys(words, lengths, n)
        found.sort()
        begins = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
        keys.append(found[begins])
        counts.append(np.diff(begins, append=len(found)).astype(np.uint32))
    whole, times = np.concatenate(keys), np.concatenate(counts)
    del keys, counts
    order = np.argsort(whole, kind="stable")  # merges sorted runs
    whole, times = whole[order], times[order]
    del order
    begins = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]])) if len(whole) else np.zeros(0, np.int64)
    if len(begins) < len(whole):  # orders that met in a hash
        whole, times = whole[begins], np.add.reduceat(times, begins)
    return whole, times


def cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of equal hash ranges begins in sorted keys."""
    edges = (np.arange(1, ranges, dtype=object) << KEY_BITS) // ranges
    return np.concatenate([[0], np.searchsorted(keys, edges.astype(np.uint64)), [len(keys)]])


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes; small ones take next to nothing."""
    import zstandard

    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).reshape(-1)


def requests(chunks: DataFrame, ranges: int) -> DataFrame:
    """For each chunk and hash range the distinct n-grams and their counts, sorted by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, sizes, body in zip(*(batch.column(c).to_pylist() for c in ("chunk", "sizes", "body"))):
                keys, counts = distinct_counted(*chunk_words(body, np.array(sizes, dtype=np.int64)))
                edges = cuts(keys, ranges)
                rows = [(r, a, b) for r, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
                if not rows:
                    continue
                gaps = [np.diff(keys[a:b], prepend=np.uint64(0)) for _, a, b in rows]
                columns = [
                    pa.array([r for r, _, _ in rows], type=pa.int32()),
                    pa.array([chunk] * len(rows), type=pa.int64()),
                    pa.array([squeezed(g) for g in gaps], type=pa.binary()),
                    pa.array([squeezed(counts[a:b]) for _, a, b in rows], type=pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["range", "chunk", "keys", "counts"])

    return chunks.select("chunk", "sizes", "body").mapInArrow(run, "range int, chunk bigint, keys binary, counts binary")


def counted(asked: DataFrame, ranges: int) -> DataFrame:
    """The count table of each hash range, joined back to every chunk's n-grams in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, bytes]] = []
        current = None

        def answered() -> Iterator[pa.RecordBatch]:
            lists = [np.cumsum(unsqueezed(k, np.uint64)) for _, k, _ in held]
            own = np.concatenate([unsqueezed(c, np.uint32) for _, _, c in held]).astype(np.float64)
            _, place = np.unique(np.concatenate(lists), return_inverse=True)
            totals = np.bincount(place, weights=own)[place].astype(np.uint64)
            ends = np.cumsum([len(x) for x in lists])
            parts = [squeezed(totals[e - len(x) : e]) for x, e in zip(lists, ends)]
            columns = [
                pa.array([c for c, _, _ in held], type=pa.int64()), pa.array([current] * len(held), type=pa.int32()),
                pa.array(parts, type=pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "range", "totals"])

        for batch in batches:
            for r, chunk, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("range", "chunk", "keys", "counts"))):
                if r != current and held:
                    yield from answered()
                    held = []
                current = r
                held.append((chunk, keys, counts))
        if held:
            yield from answered()

    dealt = asked.repartition(ranges, "range").sortWithinPartitions("range", "chunk")
    return dealt.mapInArrow(run, "chunk bigint, range int, totals binary")


def others_of(words: np.ndarray, lengths: np.ndarray, keys: np.ndarray, totals: np.ndarray, n: int) -> np.ndarray:
    """For each n-gram of a chunk, how often the other documents hold it; documents end to end."""
    found = ngram_keys(words, lengths, n)
    own, place = np.unique(found, return_inverse=True)
    del found
    place = np.searchsorted(keys, own).astype(np.int32)[place]
    out = totals[place].astype(np.float64)
    at = 0
    for count in np.maximum(lengths - n + 1, 0).tolist():
        if count:
            _, inverse, held = np.unique(place[at : at + count], return_inverse=True, return_counts=True)
            out[at : at + count] -= held[inverse]
            at += count
    return out


def document_scores(others: list[np.ndarray], lengths: np.ndarray, words: int) -> list[tuple[int, float]]:
    """Words and summed log score of each document of a chunk."""
    out, at = [], [0] * ORDER
    for n in lengths.tolist():
        here = []
        for k in range(ORDER):
            count = max(n - k, 0)
            here.append(others[k][at[k] : at[k] + count])
            at[k] += count
        rest = max(words - n, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(here[0] > 0, here[0] / rest, ALPHA / rest)
            for k in range(1, ORDER):
                found = here[k]
                if len(found):
                    context = here[k - 1][: len(found)]
                    score[k:] = np.where(found > 0, found / context, ALPHA * score[k:])
        out.append((n, float(np.log(score).sum())))
    return out


def scores(documents: DataFrame) -> DataFrame:
    """doc_id, n_words and log_score of every row."""
    spark = documents.sparkSession
    chunks = stored(packed(documents), "chunks")
    words = chunks.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(parallelism(spark), -(-words // RANGE_WORDS))
    answers = counted(requests(chunks, ranges), ranges)
    both = chunks.select("chunk", F.lit(-1).alias("range"), "doc_ids", "sizes", "body").unionByName(
        answers.select("chunk", "range", F.col("totals").alias("body")), allowMissingColumns=True
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, parts = None, []

        def made() -> pa.RecordBatch:
            doc_ids, sizes, body = head
            hashes, lengths = chunk_words(body, np.array(sizes, dtype=np.int64))
            keys = distinct_counted(hashes, lengths)[0]
            totals = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            parts.clear()
            others = [others_of(hashes, lengths, keys, totals, n) for n in range(1, ORDER + 1)]
            del hashes, keys, totals
            found = document_scores(others, lengths, words)
            columns = [
                pa.array(doc_ids, type=pa.int64()), pa.array([n for n, _ in found], type=pa.int64()),
                pa.array([s for _, s in found], type=pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "log_score"])

        for batch in batches:
            for r, doc_ids, sizes, body in zip(*(batch.column(c).to_pylist() for c in ("range", "doc_ids", "sizes", "body"))):
                if r < 0:
                    if head is not None:
                        yield made()
                    head, parts = (doc_ids, sizes, body), []
                else:
                    parts.append(unsqueezed(body, np.uint64))
        if head is not None:
            yield made()

    dealt = both.repartition(max(parallelism(spark), -(-words * 7 // CHUNK_BYTES)), "chunk").sortWithinPartitions("chunk", "range")
    return dealt.mapInArrow(run, "doc_id bigint, n_words bigint, log_score double")


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scores(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"))


ORACLE_SQL = rf"""
WITH t AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS c,
    unnest(list_prepend(NULL, w)[1:len(w)]) AS b, unnest(list_prepend(NULL, list_prepend(NULL, w))[1:len(w)]) AS a FROM t),
c1 AS (SELECT c, count(*) AS n FROM p GROUP BY ALL),
c2 AS (SELECT b, c, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY ALL),
c3 AS (SELECT a, b, c, count(*) AS n FROM p WHERE a IS NOT NULL GROUP BY ALL),
d1 AS (SELECT doc_id, c, count(*) AS n FROM p GROUP BY ALL),
d2 AS (SELECT doc_id, b, c, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY ALL),
d3 AS (SELECT doc_id, a, b, c, count(*) AS n FROM p WHERE a IS NOT NULL GROUP BY ALL),
o1 AS (SELECT doc_id, c, c1.n - d1.n AS n FROM d1 JOIN c1 USING (c)),
o2 AS (SELECT doc_id, b, c, c2.n - d2.n AS n FROM d2 JOIN c2 USING (b, c)),
o3 AS (SELECT doc_id, a, b, c, c3.n - d3.n AS n FROM d3 JOIN c3 USING (a, b, c)),
x AS (
    SELECT p.doc_id, o1.n AS n1, o2.n AS n2, o3.n AS n3, v1.n AS m1, v2.n AS m2,
        greatest((SELECT count(*) FROM p) - len(t.w), 1) AS rest
    FROM p JOIN t USING (doc_id)
    JOIN o1 ON o1.doc_id = p.doc_id AND o1.c = p.c
    LEFT JOIN o2 ON o2.doc_id = p.doc_id AND o2.b = p.b AND o2.c = p.c
    LEFT JOIN o3 ON o3.doc_id = p.doc_id AND o3.a = p.a AND o3.b = p.b AND o3.c = p.c
    LEFT JOIN o1 v1 ON v1.doc_id = p.doc_id AND v1.c = p.b
    LEFT JOIN o2 v2 ON v2.doc_id = p.doc_id AND v2.b = p.a AND v2.c = p.b),
s1 AS (SELECT *, CASE WHEN n1 > 0 THEN n1 / rest ELSE {ALPHA}::DOUBLE / rest END AS s FROM x),
s2 AS (SELECT * REPLACE (CASE WHEN n2 IS NULL THEN s WHEN n2 > 0 THEN n2 / m1 ELSE {ALPHA}::DOUBLE * s END AS s) FROM s1),
s3 AS (SELECT * REPLACE (CASE WHEN n3 IS NULL THEN s WHEN n3 > 0 THEN n3 / m2 ELSE {ALPHA}::DOUBLE * s END AS s) FROM s2),
z AS (SELECT doc_id, count(*) AS n, sum(ln(s)) AS v FROM s3 GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, coalesce(round(v, 6), 0) AS log_score FROM t LEFT JOIN z USING (doc_id)
"""
