"""Large CSV and JSON files whose records may cross line and block bounds, read by many tasks.

A file is read in its blocks, each cut at a separator byte: line feeds for CSV, closing braces for JSON. What a
separator means depends on the text before it, all the way from the beginning of the file. So the text is read
twice:

1. Each block is summed up without knowing how it begins: CSV by the parity of its quotes, JSON by that and by
   the change of depth for either state of the first byte. One row per block, stored.
2. Prefix sums over the blocks of a file tell each block its state at the start. It then cuts its records itself;
   pieces of records that cross a block's end are put together, at most two pieces per block and record.

The block table has one small row per block (128 MB by default) and is broadcast, 25 MB for 100 TB.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import materialize

_PLACE = ["file", "block"]
_PIECES = "file string, block bigint, number bigint, kind int, text string"
WHOLE, HEAD, BEFORE = 0, 1, 2  # a record; one that its block does not end; text of a record begun in a block before
_TOKEN = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_STEP = {"{": 1, "[": 1, "}": -1, "]": -1}


def _parts(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Text between separators, in file order inside each task."""
    raw = spark.read.option("lineSep", separator).text(path)
    return raw.select("value", F.input_file_name().alias("file"), F.input_file_block_start().alias("block"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Batches cut where the block changes, with the block's key columns (all but the text)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks = batch.column("block").to_numpy(zero_copy_only=False)
        files = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        changes = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(files) != 0)) + 1
        cuts = [0, *changes.tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            part = batch.slice(begin, end - begin)
            yield tuple(c[0].as_py() for c in part.columns[1:]), part


def _started(summary: DataFrame) -> DataFrame:
    """Per block: whether it begins inside quotes, and (JSON) its depth there."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)).cast("int")
    change = F.when(F.col("inside") == 1, F.col("depth_in")).otherwise(F.col("depth_out"))
    marked = summary.withColumn("inside", inside).withColumn("change", change)
    return marked.select(*_PLACE, "inside", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"))


def _joined(pieces: DataFrame, between: str) -> DataFrame:
    """Whole records: file, block and number of their beginning, and their text."""
    crossing = pieces.where(F.col("kind") != WHOLE)
    # what is left of an earlier record comes before a record that begins in the block
    order = Window.partitionBy("file").orderBy("block", F.desc("kind"))
    owned = crossing.withColumn("record", F.count_if(F.col("kind") == HEAD).over(order))
    piece = F.struct("block", F.col("kind") == HEAD, "text")
    ordered = F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["text"])
    whole = owned.groupBy("file", "record").agg(
        F.min("block").alias("block"), F.max(F.when(F.col("kind") == HEAD, F.col("number"))).alias("number"),
        F.array_join(ordered, between).alias("text"),
    )
    return pieces.where(F.col("kind") == WHOLE).drop("kind").unionByName(whole.drop("record"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV files with quoted line breaks: ``file``, ``block``, ``number`` (these order them) and ``text``.

    Quotes are doubled inside quoted fields, so a line feed ends a record where the quotes before it are even. The
    header is the first record of each file. A last record whose quotes never close reaches to the end of its file.
    """
    lines = _parts(spark, path, "\n")
    quotes = F.char_length("value") - F.char_length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    nothing = F.lit(0).cast("bigint")
    summary = lines.groupBy(*_PLACE).agg(F.sum(quotes).alias("quotes")).select("*", nothing.alias("depth_in"), nothing.alias("depth_out"))
    starts = materialize(_started(materialize(summary, "blocks")), "starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number, begun, buffer, kind = None, 0, 0, [], None
        for key, part in _runs(batches):
            out: list[tuple] = []
            if key[:2] != place:
                if kind is not None:
                    out.append((*place, begun, kind, "\n".join(buffer)))
                place, number, begun, buffer = key[:2], 0, 0, []
                kind = BEFORE if key[2] else None
            odd = pc.count_substring(part.column("value"), '"').to_numpy(zero_copy_only=False) % 2
            state = (np.concatenate([[0], np.cumsum(odd)[:-1]]) + (kind is not None)) % 2
            plain = (state == 0) & (odd == 0)
            numbers = number + np.arange(part.num_rows)
            n = int(plain.sum())
            if n:
                kept = part.filter(pa.array(plain))
                yield pa.RecordBatch.from_arrays(
                    [kept.column("file"), kept.column("block"), pa.array(numbers[plain]), pa.array(np.zeros(n, np.int32)), kept.column("value")],
                    names=["file", "block", "number", "kind", "text"],
                )
            values = part.column("value")
            for i in np.flatnonzero(~plain).tolist():
                text = values[i].as_py()
                if kind is None:
                    buffer, kind, begun = [text], HEAD, int(numbers[i])
                    continue
                buffer.append(text)
                if odd[i]:
                    out.append((*place, begun, BEFORE if kind == BEFORE else WHOLE, "\n".join(buffer)))
                    buffer, kind = [], None
            number += part.num_rows
            if out:
                yield _batch(out)
        if kind is not None:
            yield _batch([(*place, begun, kind, "\n".join(buffer))])

    placed = lines.join(F.broadcast(starts), _PLACE).select("value", *_PLACE, "inside")
    pieces = materialize(placed.mapInArrow(cut, _PIECES), "pieces")
    return _joined(pieces, "\n").withColumn("text", F.regexp_replace("text", "\r$", ""))


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """Objects of the record array of JSON documents: ``file``, 0-based ``position`` in the array, and ``text``.

    A file holds one document: an object with one array of objects, whose elements are the records.
    """
    chunks = _parts(spark, path, "}")

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, quotes, depth = None, 0, [0, 0]
        for key, part in _runs(batches):
            if key != place:
                if place is not None:
                    yield _summary(place, quotes, depth)
                place, quotes, depth = key, 0, [0, 0]
            for text in part.column("value").to_pylist():
                for token in _TOKEN.findall(text):
                    if token == '"':
                        quotes += 1
                    elif token in _STEP:
                        depth[quotes % 2] += _STEP[token]
                depth[quotes % 2] -= 1  # the separator
        if place is not None:
            yield _summary(place, quotes, depth)

    schema = "file string, block bigint, quotes bigint, depth_out bigint, depth_in bigint"
    # in a task, a block is one run of rows
    summary = materialize(chunks.mapInArrow(sum_up, schema), "blocks")
    starts = materialize(_started(summary), "starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, inside, depth, number, buffer, kind = None, False, 0, 0, [], None
        for key, part in _runs(batches):
            out: list[tuple] = []
            if key[:2] != place:
                if kind is not None:
                    out.append((*place, number - (kind == HEAD), kind, "".join(buffer)))
                place, inside, depth, number, buffer = key[:2], bool(key[2]), key[3], 0, []
                kind = BEFORE if depth > 2 else None
            for text in part.column("value").to_pylist():
                begin = 0
                for token in _TOKEN.finditer(text):
                    mark = token.group()
                    if mark == '"':
                        inside = not inside
                    elif not inside and mark in _STEP:
                        if mark == "{" and depth == 2:
                            kind, buffer, begin, number = HEAD, [], token.start(), number + 1
                        depth += _STEP[mark]
                if kind is not None:
                    buffer.append(text[begin:] + "}")
                if not inside:
                    depth -= 1
                    if depth == 2 and kind is not None:
                        out.append((*place, number - (kind == HEAD), BEFORE if kind == BEFORE else WHOLE, "".join(buffer)))
                        kind, buffer = None, []
            if out:
                yield _batch(out)
        if kind is not None:
            yield _batch([(*place, number - (kind == HEAD), kind, "".join(buffer))])

    placed = chunks.join(F.broadcast(starts), _PLACE).select("value", *_PLACE, "inside", "depth")
    pieces = materialize(placed.mapInArrow(cut, _PIECES), "pieces")
    begun = pieces.where(F.col("kind") != BEFORE).groupBy(*_PLACE).agg(F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = begun.select(*_PLACE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    records = _joined(pieces, "").join(F.broadcast(offsets), _PLACE)
    return records.select("file", (F.col("offset") + F.col("number")).alias("position"), "text")


def _summary(place: tuple, quotes: int, depth: list[int]) -> pa.RecordBatch:
    names = ["file", "block", "quotes", "depth_out", "depth_in"]
    return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*place, quotes, *depth)], names=names)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    columns = [pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["file", "block", "number", "kind", "text"])
