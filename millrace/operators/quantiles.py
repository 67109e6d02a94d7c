"""Exact quantiles whose memory does not grow with the size of a group.

``percentile`` keeps every distinct value of a group in one buffer, so a group
that holds a third of a large table ends in one task. Here a bounded sketch first
brackets each wanted rank. Rows outside the brackets then collapse, map-side, to one
counted row per gap; the values inside are counted in chunks of the bracket, and only
the chunk that holds the rank is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import attach, materialize

SKETCH_ACCURACY = 10_000
CHUNKS = 1024
CHUNK_WIDTH = 4096


def quantiles(
    rows: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    how: str = "linear",
    approx: bool = False,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Quantiles of ``value`` per group: columns ``by``, ``n`` and ``quantiles``.

    ``how`` is ``linear`` (interpolate between neighbours) or ``nearest`` (the
    value at rank ``round((n - 1) * p)``). Missing values and missing keys are
    left out. ``approx=True`` answers from the sketch alone, in one pass.
    """
    if how not in ("linear", "nearest"):
        raise ValueError("how must be 'linear' or 'nearest'")
    if not probs or any(not 0 <= p <= 1 for p in probs):
        raise ValueError("probabilities must lie between 0 and 1")
    keys = list(by)
    kept = rows.select(*keys, F.col(value).cast("double").alias("_v"))
    kept = kept.dropna(subset=["_v", *keys])
    if approx:
        sketch = F.percentile_approx("_v", F.array(*map(F.lit, probs)), accuracy)
        return kept.groupBy(*keys).agg(F.count("*").alias("n"), sketch.alias("quantiles"))

    counted = _count_in_brackets(_with_brackets(kept, keys, probs, accuracy), keys, len(probs))
    return _picked(counted, keys, probs, how)


def _picked(counted: DataFrame, keys: list[str], probs: Sequence[float], how: str) -> DataFrame:
    """Quantiles from rows per (gap, chunk, value)."""
    ranks = [rank for i, p in enumerate(probs) for rank in _ranks(i, p, how)]
    wanted = _locate(counted, keys, ranks)
    place = [*keys, "_gap", "_chunk"]
    inside = Window.partitionBy(*place, "_slot").orderBy("_mid")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.join(wanted, place).withColumn("_end", F.sum("_c").over(running))
    hit = (F.col("_local") >= F.col("_end") - F.col("_c")) & (F.col("_local") < F.col("_end"))
    picked = ranked.where(hit).groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("_slot") == slot, F.col("_mid"))).alias(f"_s{slot}") for slot in range(len(ranks))],
    )
    width = len(ranks) // len(probs)
    values = [_interpolate(i * width, p, how) for i, p in enumerate(probs)]
    return picked.select(*keys, "n", F.array(*values).alias("quantiles"))


def _with_brackets(kept: DataFrame, keys: list[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """Add ``_lo``/``_hi`` columns between which the wanted ranks are certain to lie.

    The brackets are evaluated here, once: two branches of the plan use them, and a
    sketch merged in another order could give each branch a different one.
    """
    # The sketch is off by at most n/accuracy ranks. Four times that is also more
    # than one whole rank once n > accuracy; smaller groups are kept entire.
    margin = 4 / accuracy
    bounds = [max(p - margin, 0.0) for p in probs] + [min(p + margin, 1.0) for p in probs]
    sketch = kept.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_v", F.array(*map(F.lit, bounds)), accuracy).alias("_b"),
    )
    whole = F.col("_n") <= accuracy
    columns = []
    for i in range(len(probs)):
        low, high = F.get("_b", F.lit(i)), F.get("_b", F.lit(i + len(probs)))
        columns.append(F.when(whole, F.lit(float("-inf"))).otherwise(low).alias(f"_lo{i}"))
        columns.append(F.when(whole, F.lit(float("inf"))).otherwise(high).alias(f"_hi{i}"))
    if keys:
        return attach(kept, sketch.select(*keys, *columns), keys, "inner")
    one_row = sketch.select(*columns).first().asDict()
    return kept.select("_v", *[F.lit(bound).cast("double").alias(name) for name, bound in one_row.items()])


def _count_in_brackets(tagged: DataFrame, keys: list[str], brackets: int) -> DataFrame:
    """Rows per (gap, chunk, value); ``_mid`` is NULL for the rows outside all brackets.

    Gap ``g`` reaches from the end of bracket ``g - 1`` to the end of bracket ``g``,
    so (gap, chunk, value) is the order of the values.
    """
    v = F.col("_v")
    bounds = [(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i in range(brackets)]
    inside = reduce(or_, [v.between(low, high) for low, high in bounds])
    gap = reduce(add, [F.when(v > high, 1).otherwise(0) for _, high in bounds])
    placed = tagged.withColumn("_gap", gap).withColumn("_mid", F.when(inside, v))
    chunk = F.coalesce(
        *[
            F.when(
                (F.col("_gap") == i) & (low > float("-inf")) & (high > low),
                F.floor((v - low) / (high - low) * CHUNKS),
            )
            for i, (low, high) in enumerate(bounds)
        ],
        F.lit(0),
    )
    chunk = F.when(F.col("_mid").isNull(), -1).otherwise(chunk)
    return placed.groupBy(*keys, "_gap", chunk.cast("int").alias("_chunk"), "_mid").agg(F.count("*").alias("_c"))


def _ranks(i: int, p: float, how: str) -> list[Column]:
    """0-based ranks whose values quantile ``i`` needs, in terms of ``n``."""
    if how == "nearest":
        return [F.floor(_position(p) + 0.5)]
    return [F.floor(_position(p)), F.ceil(_position(p))]


def _position(p: float) -> Column:
    return F.lit(float(p)) * (F.col("n") - 1)


def _locate(counted: DataFrame, keys: list[str], ranks: list[Column]) -> DataFrame:
    """The chunk that holds each rank, and the rank inside it.

    A group has at most one row per chunk here, however many rows it counts.
    """
    totals = counted.groupBy(*keys, "_gap", "_chunk").agg(F.sum("_c").alias("_t"))
    group = Window.partitionBy(*keys)
    running = group.orderBy("_gap", "_chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = totals.withColumn("n", F.sum("_t").over(group)).withColumn("_start", F.sum("_t").over(running) - F.col("_t"))
    slots = F.array(*[F.struct(F.lit(s).alias("slot"), r.cast("long").alias("rank")) for s, r in enumerate(ranks)])
    local = F.col("_want.rank") - F.col("_start")
    found = placed.withColumn("_want", F.explode(slots)).where((local >= 0) & (local < F.col("_t")))
    # a rank among the collapsed rows would mean that a bracket missed it
    lost = F.raise_error(F.lit("quantile rank fell outside its bracket")).cast("long")
    return found.select(
        *keys,
        "_gap",
        "_chunk",
        "n",
        F.col("_want.slot").alias("_slot"),
        F.when(F.col("_chunk") >= 0, local).otherwise(lost).alias("_local"),
    )


def _interpolate(slot: int, p: float, how: str) -> Column:
    below = F.col(f"_s{slot}")
    if how == "nearest":
        result = below
    else:
        part = _position(p) - F.floor(_position(p))
        result = below + (F.col(f"_s{slot + 1}") - below) * part
    return result


@dataclass(frozen=True)
class Request:
    """Quantiles of one column, per group of ``by`` or (without) of all rows."""

    name: str
    value: str
    probs: tuple[float, ...]
    by: tuple[str, ...] = ()


# what stands in a key column that a request does not group by; never compared across requests
_BLANK = {"string": "", "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00", "timestamp_ntz": "1970-01-01 00:00:00", "boolean": "false"}


def quantile_requests(rows: DataFrame, requests: Sequence[Request], approx: bool = False, **options) -> dict[str, DataFrame]:
    """Answers of several requests from one sketch and one count of the rows: ``by``, ``n``, a column per probability.

    Every row gives one value to each request, and all of them share a bracket table and its passes. The columns
    are named ``q0``, ``q1``, ... in the order of the request's probabilities. The answers are stored.
    """
    types = dict(rows.dtypes)
    keys = sorted({k for r in requests for k in r.by})
    probs = sorted({p for r in requests for p in r.probs})

    def asked(request: Request) -> Column:
        present = F.lit(True)
        for k in request.by:
            present = present & F.col(k).isNotNull()
        fields = [
            (F.col(k) if k in request.by else F.lit(_BLANK.get(types[k], "0")).cast(types[k])).alias(k) for k in keys
        ]
        return F.struct(F.lit(request.name).alias("_q"), *fields, F.when(present, F.col(request.value).cast("double")).alias("_w"))

    long = rows.select(F.inline(F.array(*map(asked, requests)))).where(F.col("_w").isNotNull())
    found = materialize(quantiles(long, "_w", probs, ["_q", *keys], approx=approx, **options), "quantiles")

    def answer(request: Request) -> DataFrame:
        picks = [F.get("quantiles", F.lit(probs.index(p))).alias(f"q{i}") for i, p in enumerate(request.probs)]
        return found.where(F.col("_q") == request.name).select(*request.by, "n", *picks)

    return {r.name: answer(r) for r in requests}


def counted_quantiles(
    counted: DataFrame, value: str, n: str, probs: Sequence[float], by: Sequence[str] = (), how: str = "linear"
) -> DataFrame:
    """Quantiles from counted distinct values: columns ``by``, ``n`` and ``quantiles``. Store the counts first.

    Two levels: counts per chunk of ``CHUNK_WIDTH`` place a rank in a chunk, and only that chunk's
    values are put in order. A task holds a group's chunks or one chunk's values, however many rows they count.
    """
    keys = list(by)
    known = counted.select(*keys, F.col(value).cast("double").alias("_mid"), F.col(n).alias("_c")).dropna(subset=["_mid", *keys])
    chunk = F.floor(F.col("_mid") / CHUNK_WIDTH) + (1 << 40)  # never negative
    placed = known.groupBy(*keys, F.lit(0).alias("_gap"), chunk.alias("_chunk"), "_mid").agg(F.sum("_c").alias("_c"))
    return _picked(placed, keys, probs, how)


def nearest_rank(counted: DataFrame, value: str, n: str, prob: float, by: Sequence[str]) -> DataFrame:
    """Value at rank ``round((total - 1) * prob)`` per group, from counted distinct values: ``by``, ``value``."""
    found = counted_quantiles(counted, value, n, [prob], by, "nearest")
    return found.select(*by, F.get("quantiles", F.lit(0)).alias("value"))


def quantile_columns(
    rows: DataFrame, value: str, named: dict[str, float], by: Sequence[str] = (), **options
) -> DataFrame:
    """As :func:`quantiles`, one named column per probability."""
    result = quantiles(rows, value, list(named.values()), by, **options)
    picks = [F.get("quantiles", F.lit(i)).alias(name) for i, name in enumerate(named)]
    return result.select(*by, "n", *picks)


def column_quantiles(rows: DataFrame, columns: Sequence[str], probs: Sequence[float], **options) -> DataFrame:
    """Quantiles of several numeric columns in one plan: ``column``, ``n``, ``quantiles``."""
    doubles = rows.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return quantiles(doubles.unpivot([], list(columns), "column", "value"), "value", probs, ["column"], **options)
