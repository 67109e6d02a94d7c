"""Global order without a global sort: running totals and hash cut-offs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import attach

RANGES = 1024


def running_totals(points: DataFrame, order: str, sums: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """Add ``cum_<name>``: the total of each sum over rows with ``order`` >= this row's.

    ``points`` holds one row per distinct ``order``. The values are cut into ranges
    of about equal size; totals run over the ranges first (at most ``ranges`` + 1
    rows) and then inside each range, so no task ever sorts the whole input.
    """
    steps = [i / ranges for i in range(1, ranges)]
    splits = points.agg(
        F.percentile_approx(order, F.array(*map(F.lit, steps)), ranges * 10)
    ).first()[0]
    inner = sorted({float(v) for v in splits or []})
    cut = Bucketizer(
        splits=[float("-inf"), *inner, float("inf")] if inner else [float("-inf"), 0.0, float("inf")],
        inputCol=order,
        outputCol="_range",
    ).transform(points)
    downwards = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("_range")
        .agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
        .select(
            "_range",
            *[F.coalesce(F.sum(f"_t_{s}").over(downwards), F.lit(0)).alias(f"_o_{s}") for s in sums],
        )
    )
    inside = (
        Window.partitionBy("_range")
        .orderBy(F.col(order).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # at most ranges + 1 rows, whatever the input
    joined = cut.join(F.broadcast(offsets), "_range")
    totals = [(F.col(f"_o_{s}") + F.sum(s).over(inside)).alias(f"cum_{s}") for s in sums]
    return joined.select(*points.columns, *totals)


def hash_parts(
    rows: DataFrame,
    key: str,
    stratum: str,
    cuts: Sequence[Callable[[Column], Column]],
    seed: int,
    name: str,
) -> DataFrame:
    """Cut every stratum, in seeded hash order of ``key``, after given row counts.

    Each cut maps the size of a stratum to how many of its rows lie before the cut;
    ``name`` becomes the number of cuts a row lies behind. Sizes are exact, yet no
    row is shuffled: 4 096 hash ranges are counted, the range that contains a cut is
    counted again in 4 096 parts, only that part (a stratum's 2^-24) is ranked, and the
    (hash, key) found there is a threshold for all rows.
    ``key`` must be unique.
    """
    hashed = rows.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key)))
    sizes = hashed.groupBy(stratum).agg(F.count("*").alias("_n"))
    wanted = F.array(
        *[F.struct(F.lit(i).alias("i"), c(F.col("_n")).cast("long").alias("at")) for i, c in enumerate(cuts)]
    )
    # one row per cut: the place of its row inside the hash range found so far
    open_cuts = sizes.select(stratum, F.explode(wanted).alias("_cut")).select(stratum, "_cut.i", F.col("_cut.at").alias("_local"))
    within = [stratum]
    members = hashed.select(stratum, key, "_h")
    for shift in (52, 40):
        members = members.withColumn(f"_r{shift}", F.shiftright("_h", shift))
        ranges = members.groupBy(*within, f"_r{shift}").agg(F.count("*").alias("_c"))
        running = Window.partitionBy(*within).orderBy(f"_r{shift}").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sized = ranges.withColumn("_end", F.sum("_c").over(running))
        held = attach(sized, open_cuts, within, "inner").where(
            (F.col("_local") > F.col("_end") - F.col("_c")) & (F.col("_local") <= F.col("_end"))
        )
        within = [*within, f"_r{shift}"]
        open_cuts = held.select(*within, "i", (F.col("_local") - F.col("_end") + F.col("_c")).alias("_local"))
        # only rows of a range that holds a cut go on
        members = attach(members, open_cuts.select(*within).distinct(), within, "left_semi")
    candidates = attach(members, open_cuts, within, "inner")
    ordered = Window.partitionBy(stratum, "i").orderBy("_h", key)
    found = (
        candidates.withColumn("_k", F.row_number().over(ordered))
        .where(F.col("_k") == F.col("_local"))
        .groupBy(stratum)
        .agg(*[F.max(F.when(F.col("i") == i, F.struct("_h", key))).alias(f"_t{i}") for i in range(len(cuts))])
    )
    limited = attach(hashed, found, [stratum], "left")
    here = F.struct("_h", key)
    behind = [
        F.when(F.col(f"_t{i}").isNull() | (here > F.col(f"_t{i}")), 1).otherwise(0) for i in range(len(cuts))
    ]
    return limited.select(*rows.columns, sum(behind, F.lit(0)).alias(name))


def stratified_split(
    rows: DataFrame, key: str, stratum: str, train_share: float = 0.8, seed: int = 42
) -> DataFrame:
    """Add ``split`` (``train``/``test``) with the same share of every class."""
    if not 0 < train_share < 1:
        raise ValueError("train_share must lie between 0 and 1")
    parts = hash_parts(
        rows, key, stratum, [lambda n: F.floor(n * F.lit(train_share))], seed, "_part"
    )
    return parts.select(*rows.columns, F.when(F.col("_part") == 0, "train").otherwise("test").alias("split"))


def stratified_folds(
    rows: DataFrame, key: str, stratum: str, folds: int = 5, seed: int = 43
) -> DataFrame:
    """Add ``fold`` 0..folds-1; fold sizes inside a class differ by at most one."""
    if folds < 2:
        raise ValueError("folds must be at least 2")

    def end_of(f: int) -> Callable[[Column], Column]:
        return lambda n: F.floor(n / folds) * f + F.least(F.lit(f), n % folds)

    return hash_parts(rows, key, stratum, [end_of(f) for f in range(1, folds)], seed, "fold")
