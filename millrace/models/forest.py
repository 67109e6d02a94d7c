"""Isolation forest (Liu, Ting, Zhou 2008) over window features.

Sampling, the grouping by tree and scoring are Spark plans. A tree sees at most
256 rows whatever the input, so one task builds it; the fitted forest is a table of
fewer than ``2 * 256`` nodes per tree, which bounds what scoring broadcasts. Scoring walks that
table level by level with equi-joins.

All chance comes from MD5 sums of (seed, tree, row or node), so any engine that has MD5 grows the same
forest from the same rows; ``forest_sql`` states it as SQL. The root is node 1, the children of node k
are 2k and 2k + 1.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SAMPLE_SIZE = 256
NODES = "tree int, node bigint, feature int, split double, left bigint, right bigint, path_length double"
_WALKED = "tree int, node bigint, feature int, split double, reached double"
_EULER = 0.5772156649015329


def average_path(n):
    """Mean path length of an unsuccessful search among ``n`` points: c(n)."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + _EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def _chance(*parts) -> float:
    """A number in [0, 1) from the MD5 sum of the parts."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:12], 16) / float(1 << 48)


def _grow(points: np.ndarray, seed: int, tree: int, limit: int) -> list[tuple]:
    """Nodes of one tree: (node, feature, split, left, right, path_length)."""
    nodes: list[tuple] = []
    open_nodes = [(1, np.arange(len(points)), 0)]
    while open_nodes:
        node, members, depth = open_nodes.pop()
        low, high = points[members].min(axis=0), points[members].max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or not len(varying):
            nodes.append((node, -1, 0.0, -1, -1, depth + float(average_path(len(members)))))
            continue
        feature = int(varying[int(_chance(seed, tree, node, "feature") * len(varying))])
        split = float(low[feature] + _chance(seed, tree, node, "split") * (high[feature] - low[feature]))
        if split >= high[feature]:  # rounded up to the end: both sides keep a row
            split = float(low[feature])
        goes_left = points[members, feature] <= split
        nodes.append((node, feature, split, 2 * node, 2 * node + 1, 0.0))
        open_nodes += [(2 * node, members[goes_left], depth + 1), (2 * node + 1, members[~goes_left], depth + 1)]
    return nodes


def _draw(seed: int, tree: Column, key: str) -> Column:
    """MD5 sum that orders the rows for a tree."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), tree.cast("string"), F.col(key).cast("string")).cast("binary"))


@dataclass
class IsolationForest:
    """A fitted forest: node table and how many rows each tree saw."""

    features: Sequence[str]
    nodes: pd.DataFrame
    sample_sizes: dict[int, int]
    attributes: dict = field(default_factory=dict)

    def score(self, rows: DataFrame, name: str = "anomaly_score") -> DataFrame:
        """Add the anomaly score in (0, 1]; larger is more isolated.

        A row walks all trees at once: one equi-join with the broadcast node table per level, then the
        path lengths of a row are added up, in decimals, where its trees already are.
        """
        scales = pd.Series({t: float(average_path(n)) or 1.0 for t, n in self.sample_sizes.items()})
        table = self.nodes.assign(reached=self.nodes["path_length"] / self.nodes["tree"].map(scales))
        nodes = F.broadcast(rows.sparkSession.createDataFrame(table[["tree", "node", "feature", "split", "reached"]], _WALKED))
        depth = max(int(n).bit_length() - 1 for n in self.nodes["node"])
        trees = sorted(int(t) for t in self.sample_sizes)
        point = F.array(*[F.col(f).cast("double") for f in self.features])
        walk = rows.select(
            F.struct(*rows.columns).alias("_r"), F.monotonically_increasing_id().alias("_id"), point.alias("_x")
        ).select("*", F.explode(F.array(*map(F.lit, trees))).alias("tree"), F.lit(1).cast("bigint").alias("node"))
        for _ in range(depth):
            here = walk.join(nodes, ["tree", "node"])
            right = F.when(F.get("_x", F.col("feature")) <= F.col("split"), 0).otherwise(1)
            onward = F.when(F.col("feature") >= 0, 2 * F.col("node") + right).otherwise(F.col("node"))
            walk = here.select("_r", "_id", "_x", "tree", onward.alias("node"))
        ended = walk.join(nodes, ["tree", "node"]).groupBy("_id").agg(
            F.first("_r").alias("_r"), F.sum(F.col("reached").cast("decimal(20,15)")).alias("_sum")
        )
        score = F.pow(F.lit(2.0), -F.col("_sum").cast("double") / len(trees))
        return ended.select("_r.*", score.alias(name))

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes as Parquet, the rest as one JSON row."""
        spark.createDataFrame(self.nodes, NODES).write.parquet(f"{path}/nodes")
        sizes = [(int(t), int(n)) for t, n in self.sample_sizes.items()]
        spark.createDataFrame(sizes, "tree int, size int").coalesce(1).write.parquet(f"{path}/samples")
        meta = [(list(self.features), {k: str(v) for k, v in self.attributes.items()})]
        spark.createDataFrame(meta, "features array<string>, attributes map<string,string>").coalesce(
            1
        ).write.json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        schema = "features array<string>, attributes map<string,string>"
        meta = spark.read.schema(schema).json(f"{path}/meta").first()
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes").toPandas()
        sizes = {r["tree"]: r["size"] for r in spark.read.schema("tree int, size int").parquet(f"{path}/samples").collect()}
        return cls(list(meta["features"]), nodes, sizes, dict(meta["attributes"]))


def fit_forest(
    rows: DataFrame,
    features: Sequence[str],
    key: str,
    trees: int = 200,
    sample_size: int = SAMPLE_SIZE,
    seed: int = 42,
) -> IsolationForest:
    """Fit on ``rows``; ``key`` is unique and fixes which rows a tree sees.

    Every tree gets exactly ``min(sample_size, n)`` rows: those with the smallest
    seeded hash. Only rows below a cut that twice as many are expected to pass are
    replicated, so about ``2 * trees * sample_size`` rows are shuffled whatever ``n``.
    """
    if trees < 1 or sample_size < 2:
        raise ValueError("trees must be at least 1 and sample_size at least 2")
    n = rows.count()
    share = min(1.0, 2.0 * sample_size / n) if n else 1.0
    # the first 13 digits of the sum as a share of all their values
    below = F.lit(f"{min(int(share * 16**13), 16**13 - 1):013x}" + "f" * 19)
    picks = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: _draw(seed, t, key) <= below)
    drawn = (
        rows.select(key, *[F.col(f).cast("double").alias(f) for f in features], F.explode(picks).alias("t"))
        .withColumn("_d", _draw(seed, F.col("t"), key))
        .withColumn("_k", F.row_number().over(Window.partitionBy("t").orderBy("_d", key)))
        .where(F.col("_k") <= sample_size)
        .select(F.col("t").alias("tree"), "_k", *features)
    )
    names = list(features)

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_k")
        tree = int(part["tree"].iloc[0])
        limit = math.ceil(math.log2(max(len(part), 2)))
        grown = _grow(part[names].to_numpy(dtype=float), seed, tree, limit)
        table = pd.DataFrame(grown, columns=["node", "feature", "split", "left", "right", "path_length"])
        table.insert(0, "tree", tree)
        table["size"] = len(part)
        return table

    # at most trees * 2 * sample_size rows
    fitted = drawn.groupBy("tree").applyInPandas(build, NODES + ", size int").toPandas()
    sizes = {int(t): int(s) for t, s in fitted.groupby("tree")["size"].first().items()}
    return IsolationForest(names, fitted.drop(columns="size"), sizes)


def _level_sql(level: int, features: Sequence[str], seed: int) -> str:
    """One level of all trees: its nodes, and the members of the next."""
    each = range(1, len(features) + 1)
    low = ", ".join(f"min(x[{i}])" for i in each)
    high = ", ".join(f"max(x[{i}])" for i in each)

    def chance(what: str) -> str:
        text = f"md5('{seed}:' || tree || ':' || node || ':{what}')"
        return f"(CAST('0x' || substr({text}, 1, 12) AS BIGINT) / {float(1 << 48)})"

    return f""",
spans{level} AS (
    SELECT tree, node, count(*) AS n, [{low}] AS low, [{high}] AS high FROM members{level} GROUP BY tree, node),
varying{level} AS (SELECT *, list_filter({list(each)}, lambda i: high[i] > low[i]) AS v FROM spans{level}),
chosen{level} AS (
    SELECT *, CASE WHEN len(v) > 0 AND {level} < (SELECT max_depth FROM sized)
        THEN v[CAST(floor({chance("feature")} * len(v)) AS INTEGER) + 1] END AS f FROM varying{level}),
nodes{level} AS (
    SELECT tree, node, n, f, CASE WHEN low[f] + {chance("split")} * (high[f] - low[f]) >= high[f] THEN low[f]
        ELSE low[f] + {chance("split")} * (high[f] - low[f]) END AS split FROM chosen{level}),
members{level + 1} AS (
    SELECT m.tree, 2 * m.node + CASE WHEN m.x[f] <= split THEN 0 ELSE 1 END AS node, x
    FROM members{level} m JOIN nodes{level} k ON m.tree = k.tree AND m.node = k.node WHERE f IS NOT NULL)"""


def forest_sql(
    source: str, fitted_on: str, features: Sequence[str], key: str, trees: int = 200, sample_size: int = SAMPLE_SIZE, seed: int = 42
) -> str:
    """Common table expressions that grow the forest on the rows of ``source`` that meet ``fitted_on`` and score all
    its rows: the table ``scored`` has their columns and ``anomaly_score``."""
    depth = math.ceil(math.log2(sample_size))
    point = ", ".join(f"CAST({f} AS DOUBLE)" for f in features)
    reached = f"""CASE WHEN n <= 1 THEN 0 WHEN n = 2 THEN 1
        ELSE 2 * (ln(n - 1) + {_EULER}) - 2 * CAST(n - 1 AS DOUBLE) / n END"""
    levels = "".join(_level_sql(level, features, seed) for level in range(depth + 1))
    nodes = " UNION ALL ".join(
        f"SELECT tree, node, f, split, {level} + {reached} AS path_length FROM nodes{level}" for level in range(depth + 1)
    )
    steps = "".join(
        f""",
walk{level + 1} AS (
    SELECT w.k, w.x, w.tree, CASE WHEN f IS NULL THEN w.node WHEN w.x[f] <= split THEN 2 * w.node ELSE 2 * w.node + 1 END AS node
    FROM walk{level} w JOIN nodes k ON w.tree = k.tree AND w.node = k.node)"""
        for level in range(depth)
    )
    return f"""points AS (SELECT {key} AS k, [{point}] AS x, {fitted_on} AS fitted FROM {source}),
drawn AS (
    SELECT tree, x, row_number() OVER (PARTITION BY tree ORDER BY md5('{seed}:' || tree || ':' || CAST(k AS VARCHAR)), k) AS place
    FROM points, range({trees}) t(tree) WHERE fitted),
members0 AS (SELECT tree, CAST(1 AS BIGINT) AS node, x FROM drawn WHERE place <= {sample_size}),
sized AS (
    SELECT n, CAST(ceil(log2(greatest(n, 2))) AS INTEGER) AS max_depth FROM (SELECT count(*) AS n FROM members0 WHERE tree = 0)){levels},
nodes AS ({nodes}),
walk0 AS (SELECT k, x, tree, CAST(1 AS BIGINT) AS node FROM points, range({trees}) t(tree)){steps},
scores AS (
    SELECT w.k, sum(CAST(path_length / (SELECT CASE WHEN n <= 1 THEN 1 ELSE {reached} END FROM sized) AS DECIMAL(20,15))) AS s
    FROM walk{depth} w JOIN nodes k ON w.tree = k.tree AND w.node = k.node GROUP BY w.k),
scored AS (SELECT f.*, pow(2.0::DOUBLE, -CAST(s AS DOUBLE) / {trees}) AS anomaly_score FROM {source} f JOIN scores ON f.{key} = scores.k)"""
