"""Periodic run detection: an online sparse diagonal DP over the words of each text.

A run is a stretch of consecutive words with smallest period q, of at least ``min_length``
words and ``min_periods`` periods, that no neighbouring word extends. The scan goes through
a text word by word. For each word, an earlier occurrence at lag d increments the match
length of the active diagonal d; a diagonal that ends is emitted at once if its stretch,
match length plus lag, suffices.

What keeps it sparse: an earlier occurrence counts once the ``g`` words up to it agree as
well, ``g`` being the least power of two that is at least the lag and ``start_span``. A
stretch that suffices has that many matches on its diagonal, and by the theorem of Fine
and Wilf the nearest such occurrence then lies exactly one smallest period back. So each
word has at most one earlier occurrence per power of two, diagonals begin with ``g``
matches, and a text of one repeated word costs n log n, not n². Word sequences of length
g are numbered exactly by doubling (no hashes decide); sequences that occur once in their
text drop out on the way.

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words and no run, their
collapsed text is empty. Each row is its own text, whatever its id; repeated rows give
repeated results. Overlapping runs are all reported. A very long text is one task's work in
memory linear in its words. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import WordIds, binaries, slices, table, utf8

MIN_LENGTH = 24
MIN_PERIODS = 3
SLICE_BYTES = 4 << 20
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def start_span(min_length: int, min_periods: int) -> int:
    """Largest power of two that the matches of every sufficient diagonal reach."""
    if min_periods < 3 or min_length < min_periods:
        raise ValueError("runs need at least 3 periods, and as many words")
    fewest = min(max(min_length - q, (min_periods - 1) * q) for q in range(1, min_length + 1))
    return 1 << (fewest.bit_length() - 1)


def earlier_occurrences(words: np.ndarray, lengths: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, lag, span) of the occurrences that count, by position; texts lie one after the other."""
    n = len(words)
    text = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.arange(n) - begin
    rank = np.full(n, -1, np.int64)
    alive = np.arange(n)
    keys = text * (int(words.max(initial=0)) + 1) + words
    found = []
    width = 1
    while len(alive):
        _, number, count = np.unique(keys, return_inverse=True, return_counts=True)
        rank[alive] = -1
        again = count[number] > 1
        alive, number = alive[again], number[again]
        rank[alive] = number
        if width >= span:
            order = np.argsort(number, kind="stable")
            at, same = alive[order], number[order]
            lag = at[1:] - at[:-1]
            least = 1 if width == span else width // 2 + 1
            near = (same[1:] == same[:-1]) & (lag >= least) & (lag <= width)
            found.append((at[1:][near], lag[near], np.full(int(near.sum()), width)))
        back = alive[place[alive] >= 2 * width - 1]
        back = back[rank[back - width] >= 0]
        keys = rank[back] * (n + 1) + rank[back - width]
        # places that end no longer sequence are dead from here on
        now = rank[back]
        rank[alive] = -1
        rank[back] = now
        alive = back
        width *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    at, lag, width = (np.concatenate(part) for part in zip(*found))
    order = np.argsort(at, kind="stable")
    return at[order], lag[order], width[order]


def diagonals(at: np.ndarray, lag: np.ndarray, span: np.ndarray, min_length: int, min_periods: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of sufficient runs, emitted as their diagonals end."""
    active: dict[int, int] = {}
    last = -2

    def ended(period: int, matches: int, end: int) -> Iterator[tuple[int, int, int]]:
        length = matches + period
        if length >= min_length and length >= min_periods * period:
            yield end + 1 - length, length, period

    now: dict[int, int] = {}
    for i, d, g in zip(at.tolist(), lag.tolist(), span.tolist()):
        if i != last:
            # the word before is complete: diagonals it did not continue have ended one word earlier
            for period, matches in active.items():
                if period not in now:
                    yield from ended(period, matches, last - 1)
            active, now = now, {}
            if i != last + 1:
                for period, matches in active.items():
                    yield from ended(period, matches, last)
                active = {}
            last = i
        now[d] = active[d] + 1 if d in active else g
    for period, matches in active.items():
        if period not in now:
            yield from ended(period, matches, last - 1)
    for period, matches in now.items():
        yield from ended(period, matches, last)


def find_runs(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[list[tuple[int, int, int]]]:
    """Runs of each text's words, by start and period."""
    known = WordIds()
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    words = np.fromiter((known[w] for t in texts for w in t), np.int64, int(lengths.sum()))
    ends = np.cumsum(lengths)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    hits = earlier_occurrences(words, lengths, start_span(min_length, min_periods))
    for start, length, period in diagonals(*hits, min_length, min_periods):
        k = int(np.searchsorted(ends, start, side="right"))
        runs[k].append((start - int(ends[k] - lengths[k]), length, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in runs]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept).tolist())


def periodic(documents: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Per row: doc_id, n_words, runs (array of start, length, period) and the collapsed text."""
    start_span(min_length, min_periods)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "body", SLICE_BYTES):
            texts = [body.split() for body in part.column("body").to_pylist()]
            found = find_runs(texts, min_length, min_periods)
            flat = [run for runs in found for run in runs]
            fields = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
            ends = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    lists,
                    binaries([collapsed(t, r) for t, r in zip(texts, found)]).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return documents.select("doc_id", utf8().alias("body")).mapInArrow(
        work, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string"
    )


def strongest(runs: Column) -> Column:
    """The run of greatest length/period, compared exactly; ties to the smallest start, then period."""
    first = F.get(runs, F.lit(0))
    better = lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    return F.aggregate(runs, first, better)


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """The query's edit: in a tenth of the texts, by crc32 of the id, the words from one place on repeat.

    With a null id nothing is edited.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def edit(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))).cast("int")
        copies = F.ceil((n - a) / p).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), copies))
        return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " ")

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # the one-element array gives the words a name, so that they are split once
    edited = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, edit(w)).otherwise(""))[0]
    return F.when(F.pmod(h, F.lit(10)) == 0, edited).otherwise(text)


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    edited = documents.select("doc_id", repeated_tail(F.col("doc_id"), F.col("text")).alias("text"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = strongest(F.col("runs"))
    found = periodic(edited).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best.alias("best"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
    return found.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
        "n_words",
    )
