"""Measures of a scored table: ROC-AUC, precision-recall, threshold, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranking import running_totals
from millrace.session import materialize

SCORE_RANGES = 4096


def score_points(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Positives and negatives per distinct score, stored: the rows are scored once."""
    points = scored.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return materialize(points, "points")


def pr_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Precision and recall when every score >= threshold is taken as positive.

    One row per distinct score.
    """
    stored = score_points(scored, score, label)
    positives = stored.agg(F.sum("pos").alias("p")).scalar()
    return running_totals(stored, "threshold", ["pos", "neg"]).select(
        "threshold",
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.coalesce(F.try_divide(F.col("cum_pos"), positives), F.lit(1.0)).alias("recall"),
    )


def pick_threshold(curve: DataFrame, target_recall: float = 0.60) -> DataFrame:
    """The highest threshold that still reaches the recall; fails when none does."""
    if not 0 < target_recall <= 1:
        raise ValueError("target_recall must lie in (0, 1]")
    best = curve.where(F.col("recall") >= target_recall).agg(
        F.max_by(F.struct("threshold", "precision", "recall"), "threshold").alias("b")
    )
    none = F.raise_error(F.lit(f"no threshold reaches a recall of {target_recall}"))
    kind = "struct<threshold:double,precision:double,recall:double>"
    return best.select(F.coalesce(F.col("b"), none.cast(kind)).alias("b")).select("b.*")


def roc_auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Share of (positive, negative) pairs ranked right, a tie counts half; NULL for one class."""
    points = running_totals(score_points(scored, score, label), "threshold", ["pos"])
    # negatives of this score lie below all positives of higher scores
    higher = (F.col("cum_pos") - F.col("pos")).cast("decimal(38,0)")
    twice = F.sum(F.col("neg").cast("decimal(19,0)") * (2 * higher + F.col("pos")).cast("decimal(19,0)"))
    sums = points.agg(twice.alias("twice"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    pairs = F.col("p").cast("double") * F.col("n").cast("double")
    return sums.select(F.try_divide(F.col("twice").cast("double"), 2 * pairs).alias("roc_auc"))


def roc_auc_by(scored: DataFrame, by: Sequence[str], score: str = "score", label: str = "label") -> DataFrame:
    """As :func:`roc_auc` per group, for scores in [0, 1]: ``by``, ``roc_auc``, ``n``.

    A group's positives are counted per range of scores, and distinct scores put in order inside a range only.
    """
    keys = list(by)
    counted = scored.groupBy(*keys, F.col(score).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    points = materialize(counted.withColumn("_range", F.floor(F.col("_s") * SCORE_RANGES)), "points")
    group = Window.partitionBy(*keys)
    before = group.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = points.groupBy(*keys, "_range").agg(F.sum("pos").alias("p"))
    above = ranges.select(*keys, "_range", F.coalesce(F.sum("p").over(before), F.lit(0)).alias("_above"))
    inside = Window.partitionBy(*keys, "_range").orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)
    placed = points.join(above, [*keys, "_range"]).withColumn(
        "_higher", F.col("_above") + F.coalesce(F.sum("pos").over(inside), F.lit(0))
    )
    twice = F.col("neg").cast("decimal(19,0)") * (2 * F.col("_higher") + F.col("pos")).cast("decimal(19,0)")
    sums = placed.groupBy(*keys).agg(F.sum(twice).alias("twice"), F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    pairs = F.col("p").cast("double") * F.col("q").cast("double")
    return sums.select(
        *keys, F.try_divide(F.col("twice").cast("double"), 2 * pairs).alias("roc_auc"), (F.col("p") + F.col("q")).alias("n")
    )


def classification_report(
    scored: DataFrame, threshold, score: str = "score", label: str = "label"
) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means."""
    limit = F.lit(threshold) if isinstance(threshold, (int, float)) else threshold
    predicted = (F.col(score) >= limit).cast("int")
    actual = F.col(label)
    cells = scored.agg(
        *[
            F.count_if((actual == a) & (predicted == p)).alias(f"c{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )

    def measures(own: int):
        other = 1 - own
        hit = F.col(f"c{own}{own}")
        named, support = hit + F.col(f"c{other}{own}"), hit + F.col(f"c{own}{other}")
        precision = F.coalesce(F.try_divide(hit, named), F.lit(0.0))
        recall = F.coalesce(F.try_divide(hit, support), F.lit(0.0))
        f1 = F.coalesce(F.try_divide(2.0 * hit, named + support), F.lit(0.0))
        return precision, recall, f1, support

    zero, one = measures(0), measures(1)
    total = zero[3] + one[3]
    accuracy = F.coalesce(F.try_divide(F.col("c00") + F.col("c11"), total), F.lit(0.0))

    def row(name, p, r, f, s):
        return F.struct(
            F.lit(name).alias("name"),
            p.cast("double").alias("precision"),
            r.cast("double").alias("recall"),
            f.cast("double").alias("f1"),
            s.cast("long").alias("support"),
        )

    macro = [(zero[i] + one[i]) / 2 for i in range(3)]
    weighted = [F.coalesce(F.try_divide(zero[i] * zero[3] + one[i] * one[3], total), F.lit(0.0)) for i in range(3)]
    return cells.select(
        F.inline(
            F.array(
                row("0", *zero),
                row("1", *one),
                row("accuracy", accuracy, accuracy, accuracy, total),
                row("macro avg", *macro, total),
                row("weighted avg", *weighted, total),
            )
        )
    )
