"""Fitted random forests as node tables: scores at several depths, of several forests, in one pass.

Cutting every tree of a forest at a depth gives a forest of that depth, since an inner node keeps the class
counts of its training rows. MLlib draws the features of a node in the order in which nodes are split, so a
forest grown deeper and cut is another draw of the same kind than one grown to that depth. MLlib also merges sibling
leaves that predict one class, so a forest grown to a depth is somewhat coarser there than a cut one. Where nothing
is drawn (all features, no bootstrap) the two predict the same classes.

A forest has at most ``trees * 2^(depth + 1)`` nodes, whatever it was trained on: that bounds what is
collected and broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path

# rows that walk down a tree together: their points stay in the processor's cache
CHUNK_ROWS = 8192


@dataclass
class NodeTable:
    """All trees end to end: places of the children, the split, and the share of class 1. A leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def scores(self, points: np.ndarray, depths: Sequence[int]) -> np.ndarray:
        """Mean share of class 1 over the trees cut at each depth: rows x depths."""
        found = np.zeros((len(points), len(depths)))
        children = np.stack([self.right, self.left], axis=1).ravel()
        for i in range(0, len(points), CHUNK_ROWS):
            part = points[i : i + CHUNK_ROWS]
            # feature by feature, so that a value's place is its row's number beyond that of its feature
            values, own = part.T.ravel(), np.arange(len(part))
            begin = self.feature.astype(np.int64) * len(part)
            for root in self.roots.tolist():
                at = np.full(len(part), root)
                for depth in range(max(depths) + 1):
                    for k, wanted in enumerate(depths):
                        if wanted == depth:
                            found[i : i + CHUNK_ROWS, k] += self.share.take(at)
                    if depth < max(depths):
                        left = values.take(begin.take(at) + own) <= self.split.take(at)
                        at = children.take(2 * at + left)
        found /= len(self.roots)
        return found


def node_table(model: RandomForestClassificationModel) -> NodeTable:
    """The nodes of a fitted forest, from its stored form."""
    session = SparkSession.active()
    path = scratch_path(session, "random-forest")
    model.write().save(path)
    rows = session.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.impurityStats").alias("stats"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("sides"),
        F.col("nodeData.split.numCategories").alias("categories"),
    )
    return packed(rows.toPandas())


def packed(nodes: pd.DataFrame) -> NodeTable:
    nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
    if (nodes["categories"] > 2).any():
        raise ValueError("nominal features of more than two values must be one-hot encoded")
    begin = nodes.groupby("tree")["node"].transform("size").groupby(nodes["tree"]).first().cumsum().shift(fill_value=0)
    base = nodes["tree"].map(begin).to_numpy()
    own = np.arange(len(nodes))
    inner = (nodes["feature"] >= 0).to_numpy()
    left = np.where(inner, base + nodes["left"].to_numpy(), own)
    right = np.where(inner, base + nodes["right"].to_numpy(), own)
    first = np.array([s[0] if len(s) else 0.0 for s in nodes["sides"]], dtype=float)
    # a feature of two values goes left with one of them: below 0.5, or above with the sides exchanged
    two = inner & (nodes["categories"] == 2).to_numpy()
    exchanged = two & (first > 0.5)
    left, right = np.where(exchanged, right, left), np.where(exchanged, left, right)
    stats = np.array([list(s) for s in nodes["stats"]], dtype=float)
    return NodeTable(
        roots=begin.to_numpy().astype(np.int64),
        feature=np.where(inner, nodes["feature"].to_numpy(), 0),
        split=np.where(two, 0.5, first),
        left=left,
        right=right,
        share=stats[:, 1] / stats.sum(axis=1),
    )


def cut_scores(rows: DataFrame, features: str, fold: str, forests: dict[int, list[NodeTable]], depths: Sequence[int]) -> Column:
    """Scores of each row by the forests of its fold: an array, depth by depth for one forest after the other."""
    shared = rows.sparkSession.sparkContext.broadcast(forests)
    wanted = list(depths)

    @F.pandas_udf("array<double>")
    def score(points: pd.Series, folds: pd.Series) -> pd.Series:
        out: list = [None] * len(points)
        for number in folds.unique():
            here = np.flatnonzero(folds.to_numpy() == number)
            for i in range(0, len(here), CHUNK_ROWS):
                part = here[i : i + CHUNK_ROWS]
                x = np.stack(points.iloc[part].to_list())
                found = np.concatenate([f.scores(x, wanted) for f in shared.value[int(number)]], axis=1)
                for place, line in zip(part.tolist(), found.tolist()):
                    out[place] = line
        return pd.Series(out, dtype=object)

    return score(F.col(features), F.col(fold))
