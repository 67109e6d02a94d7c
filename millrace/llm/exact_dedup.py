"""Exact deduplication by Grace hashing.

Texts are equal when identical after deleting ASCII blanks (``[\\x20\\x09-\\x0D]``). Each
map task first merges equal texts it meets itself, in an open-addressing table that
compares complete content; so of a group of copies at most one text per task (and per
emptying of its table) is shuffled, however large the group. Its rows are stored once in the shared folder.
The texts that are left are dealt by hash to partitions; there they pass through
recursive partitions in spill files until what a file holds fits the table. Every row then
finds its class by the key of the text that stood for it, so no task gathers a group's rows.

Of equal texts the row with the most code points in the original text stays, then the
smallest doc_id (null last); of repeated rows that tie in all of these exactly one stays.
Null counts as empty; all blank texts form one group. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import discarded, keep_rows, mark, parallelism, slices, stored, table, utf8

BLANKS = b" \t\n\x0b\x0c\r"
TABLE_BYTES = 48 << 20  # contents that one table may hold before it is emptied or split
FANOUT = 16  # spill files of one split


class Entry:
    """A distinct text: its rows' number, the best row and the keys that stand for it."""

    __slots__ = ("hash", "content", "best", "size", "keys")

    def __init__(self, hash: int, content: bytes, best: tuple, size: int, keys: list[int]) -> None:
        self.hash, self.content, self.best, self.size, self.keys = hash, content, best, size, keys

    def absorb(self, best: tuple, size: int, keys: list[int]) -> None:
        self.best = min(self.best, best)
        self.size += size
        self.keys += keys


class ContentTable:
    """Open addressing with linear probing; equal hashes are told apart by their content."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, dtype=np.int64)
        self.entries: list[Entry] = []
        self.held = 0

    def _slot(self, hash: int, content: bytes | None) -> tuple[int, Entry | None]:
        mask = len(self.slots) - 1
        at = (hash >> 16) & mask
        while (number := self.slots[at]) >= 0:
            entry = self.entries[number]
            if content is not None and entry.hash == hash and entry.content == content:
                return at, entry
            at = (at + 1) & mask
        return at, None

    def find(self, hash: int, content: bytes) -> Entry | None:
        return self._slot(hash, content)[1]

    def insert(self, entry: Entry) -> None:
        if 2 * (len(self.entries) + 1) > len(self.slots):
            self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
            for number, other in enumerate(self.entries):
                self.slots[self._slot(other.hash, None)[0]] = number
        self.slots[self._slot(entry.hash, None)[0]] = len(self.entries)
        self.entries.append(entry)
        self.held += len(entry.content) + 200


def grace(records: Iterable[Entry], limit: int = TABLE_BYTES, level: int = 0) -> Iterator[Entry]:
    """Merge equal entries; what outgrows the limit is split by further bits of the hash into files."""
    found = ContentTable()
    source = iter(records)
    for record in source:
        known = found.find(record.hash, record.content)
        if known is not None:
            known.absorb(record.best, record.size, record.keys)
            continue
        found.insert(record)
        if found.held > limit and level < 12:
            break
    else:
        yield from found.entries
        return
    with tempfile.TemporaryDirectory() as folder:
        files = [Path(folder, str(i)).open("w+b") for i in range(FANOUT)]
        for part in (found.entries, source):
            for x in part:
                pickle.dump((x.hash, x.content, x.best, x.size, x.keys), files[x.hash >> (4 * level) & FANOUT - 1], protocol=5)
        found = ContentTable()
        for file in files:
            file.seek(0)
            with file:
                yield from grace(_spilled(file), limit, level + 1)


def _spilled(file) -> Iterator[Entry]:
    while True:
        try:
            yield Entry(*pickle.load(file))
        except EOFError:
            return


def _rank(n_chars: int, doc_id: int | None, row: int) -> tuple:
    """Smaller is better: most code points, smallest id, null last, first row."""
    return (-n_chars, doc_id is None, doc_id or 0, row)


_LOCAL = "doc_id bigint, mark bigint, row bigint, n_chars bigint, text_sha256 string, key bigint, hash bigint, size bigint, content binary"


def local_groups(documents: DataFrame, limit: int = TABLE_BYTES) -> DataFrame:
    """Each row with the key of the text that stands for it in its task; and those texts (content set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        row = base
        found = ContentTable()
        names = [x.split()[0] for x in _LOCAL.split(", ")]
        kinds = [*[pa.int64()] * 4, pa.string(), *[pa.int64()] * 3, pa.binary()]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)

        def standing() -> Iterator[pa.RecordBatch]:
            rows, held = [], 0
            for x in found.entries:
                n_chars, no_id, doc_id, best = x.best
                rows.append((None if no_id else doc_id, None, best, -n_chars, None, x.keys[0], x.hash - (1 << 63), x.size, x.content))
                held += len(x.content)
                if held > 8 << 20:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

        for batch in slices(batches, "body"):
            rows = []
            for doc_id, text_mark, n_chars, body in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "mark", "n_chars", "body"))):
                content = body.translate(None, BLANKS)
                digest = hashlib.sha256(content)
                hash = int.from_bytes(digest.digest()[:8], "big")
                best = _rank(n_chars, doc_id, row)
                entry = found.find(hash, content)
                if entry is None:
                    entry = Entry(hash, content, best, 1, [row])
                    found.insert(entry)
                else:
                    entry.absorb(best, 1, [])
                rows.append((doc_id, text_mark, row, n_chars, digest.hexdigest(), entry.keys[0], None, None, None))
                row += 1
            yield made(rows)
            if found.held > limit:
                yield from standing()
                found = ContentTable()
        yield from standing()

    text = F.coalesce("text", F.lit(""))
    keyed = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        mark().alias("mark"),
        F.char_length(text).cast("bigint").alias("n_chars"),
        utf8().alias("body"),
    )
    return keyed.mapInArrow(run, _LOCAL)


_CLASS = "key bigint, keep_id bigint, keep_row bigint, group_size bigint"


def classes(texts: DataFrame, limit: int = TABLE_BYTES) -> DataFrame:
    """For each standing text's key the row that its group keeps, and the group's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Entry]:
            for batch in slices(batches, "content"):
                names = ("doc_id", "row", "n_chars", "key", "hash", "size", "content")
                for doc_id, row, n_chars, key, hash, size, content in zip(*(batch.column(c).to_pylist() for c in names)):
                    yield Entry(hash + (1 << 63), content, _rank(n_chars, doc_id, row), size, [key])

        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            names = [x.split()[0] for x in _CLASS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*out)], names=names)

        for x in grace(records(), limit):
            _, no_id, doc_id, row = x.best
            out += [(key, None if no_id else doc_id, row, x.size) for key in x.keys]
            if len(out) > 10_000:
                yield made()
                out.clear()
        if out:
            yield made()

    return texts.repartition(4 * parallelism(texts.sparkSession), "hash").mapInArrow(run, _CLASS)


def grouped(documents: DataFrame, limit: int = TABLE_BYTES) -> DataFrame:
    """Every row with its group: doc_id, mark, keep_id, group_size, kept, text_sha256."""
    return joined(stored(local_groups(documents, limit), "exact"), limit)


def joined(local: DataFrame, limit: int) -> DataFrame:
    """The rows of ``local_groups`` with the class of the text that stands for them."""
    texts = local.where(F.col("content").isNotNull()).drop("text_sha256")
    rows = local.where(F.col("content").isNull()).select("doc_id", "mark", "row", "text_sha256", "key")
    return rows.join(classes(texts, limit), "key").select(
        "doc_id", "mark", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )


def deduplicated(documents: DataFrame, limit: int = TABLE_BYTES) -> DataFrame:
    """The documents with one row of each group of equal texts; the stored texts are gone before these are read again."""
    local = stored(local_groups(documents, limit), "exact")
    keys = stored(joined(local, limit).where("kept").select("doc_id", "mark"), "kept")
    discarded(local)
    return keep_rows(documents, keys)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("mark")


ORACLE_SQL = r"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS c, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
    FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
    doc_id = first_value(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t ORDER BY c DESC, doc_id)
"""
