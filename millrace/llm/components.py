"""Connected components of a link table by repeated minima, stored after every round.

The labels are broadcast if there are at most ``MOST_BROADCAST`` link ends, and joined by shuffles beyond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fewer, stored

MOST_BROADCAST = 100_000  # rows of two longs: 1.6 MB


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node reachable) of all nodes in ``links`` (a, b).

    A round points every node to the smallest label around it, then to that label's own label, so
    paths halve. Rounds end when no label moves. All joins are on node
    ids; a hot node's links are first reduced to one minimum per task.
    """
    given = links.count()
    both = stored(fewer(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), given), "links")
    ends = both.count()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label"))
    labels = stored(fewer(labels, ends), "labels")
    while True:
        if ends <= MOST_BROADCAST:
            labels = labels.hint("broadcast")
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        # the label of the label: a label is a node of the table itself
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        moved = near.join(labels, "node").join(up, "label").select(
            "node", "label", F.least("label", "near", "up").alias("new")
        )
        moved = stored(fewer(moved, ends), "labels")
        labels = moved.select("node", F.col("new").alias("label"))
        if moved.where("new <> label").isEmpty():
            return labels
