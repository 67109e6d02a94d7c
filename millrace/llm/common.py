"""Helpers the operators share: columns, word hashing, scratch copies, packed arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import delete_stored, materialize

# rows that one step inside a task holds at once, counted in bytes of text
SLICE_BYTES = 8 << 20
# rows that are worth a task of their own, see ``fewer``
TASK_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """One evaluation kept in the shared folder: survives a lost executor."""
    return materialize(df, label)


def discarded(*copies: DataFrame) -> None:
    """Give back the disk of the ``stored`` tables behind these frames; nothing may read them any more."""
    for df in copies:
        delete_stored(df)


def utf8(column: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def mark(column: str = "text") -> Column:
    """64-bit hash of a row's text, which tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def keep_rows(documents: DataFrame, keys: DataFrame) -> DataFrame:
    """For each distinct (doc_id, mark) of ``keys`` one row of the documents, with their columns.

    Texts are shuffled once: repeated rows are dropped and keys joined on the same columns, a null id being told apart by
    ``none``. Of repeated rows each task hands on one.
    """
    a, none, b, n = (free_name(documents, x) for x in ("__keep_id", "__keep_none", "__keep_mark", "__keep_no"))

    def keyed(df: DataFrame, mark: Column) -> DataFrame:
        id = F.col("doc_id").cast("bigint")
        return df.withColumns({a: F.coalesce(id, F.lit(0)), none: id.isNull(), b: mark})

    wanted = keyed(keys, F.col("mark")).select(a, none, b).distinct()
    first = Window.partitionBy(a, none, b).orderBy(F.lit(0))
    single = keyed(documents, mark()).withColumn(n, F.row_number().over(first)).where(F.col(n) == 1)
    return single.join(wanted, [a, none, b]).drop(a, none, b, n)


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def fewer(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more tasks than one per ``TASK_ROWS`` of the given rows, and one per task slot.

    A small table in a session of many shuffle partitions else costs a task, a Python worker's round and a file for every few
    rows wherever the adaptive planner merges none. Tables with more rows than that keep their partitions.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``limit`` bytes in ``column``.

    A single row above the limit is a run of its own: texts are never cut.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(offsets_of(batch.column(column)))
        block = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            yield batch.slice(begin, end - begin)


def with_bytes(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES, column: str = "text") -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of rows as ``slices`` cuts them, each with its texts as UTF-8 bytes, null as empty.

    The bytes are those of the column itself, so a text that is also handed on goes to Python once.
    """
    for batch in batches:
        text = batch.column(next(n for n in batch.schema.names if n.lower() == column))
        kind = pa.large_binary() if pa.types.is_large_string(text.type) else pa.binary()
        body = text.cast(kind).fill_null(b"")
        names = [str(k) for k in range(batch.num_columns)]
        joined = pa.RecordBatch.from_arrays([*batch.columns, body], names=[*names, "body"])
        for part in slices([joined], "body", limit):
            yield pa.RecordBatch.from_arrays(part.columns[:-1], names=batch.schema.names), part.column("body")


def offsets_of(array: pa.Array) -> np.ndarray:
    """Byte offsets of a binary column's values, relative to its buffer."""
    kind = np.int64 if pa.types.is_large_binary(array.type) or pa.types.is_large_string(array.type) else np.int32
    whole = np.frombuffer(array.buffers()[1], dtype=kind)
    return whole[array.offset : array.offset + len(array) + 1].astype(np.int64)


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix); wraps on purpose."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordIds(dict):
    """Running number of each distinct word seen in a task, given out on first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class WordHashes(dict):
    """64-bit hash of each distinct word; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 500_000) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def hashed_words(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of fewer, the whole as one."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, np.uint64(size))
    with np.errstate(over="ignore"):
        for k in range(size):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += words[k : k + n]
        return np.unique(mix(h))


def permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``count`` universal (multiply-add, 32-bit) hash functions."""
    draw = np.random.default_rng(seed)
    a = draw.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, draw.integers(0, 2**32, count, dtype=np.uint32)


def minhash(items: np.ndarray, a: np.ndarray, b: np.ndarray, chunk: int = 4096) -> np.ndarray:
    """Minimum of each permutation over 64-bit items, as 32-bit numbers; no items: all ones."""
    best = np.full(len(a), np.uint32(2**32 - 1))
    x = (items >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(x), chunk):
            h = a[:, None] * x[None, i : i + chunk]
            h += b[:, None]
            np.minimum(best, h.min(axis=1), out=best)
    return best


def shortened(mins: np.ndarray) -> np.ndarray:
    """Lower 16 bits of minima. The upper ones are nearly all zero for long texts and tell nothing."""
    return (mins & np.uint32(0xFFFF)).astype(np.uint16)


def binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())


def ragged(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column from flat values and the length of each list."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))
