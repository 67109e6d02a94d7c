"""Random forests for two classes, grown inside tasks: every task holds a fold's rows in bins and grows some of its trees.

As in MLlib, whose jobs per level and forest this saves: at most ``BINS`` bins a feature, Poisson(1) counts of the rows for each tree,
ceil(sqrt) of the features drawn for each node, the largest gain in Gini impurity among splits that leave ``leaf`` counted
rows on either side, ties to the smaller feature and threshold. Unlike there, all rows and not a sample choose the bins, and sibling
leaves that predict one class stay apart.

Forests of several leaf sizes are grown together: they draw the same, so they share a node and its histograms until
they split it differently. Each is the forest that is grown for its leaf size alone.

A row takes a byte per feature. A task needs about three bytes per feature and 40 more for a row, whatever the trees; folds of more than
``MOST_CELLS`` rows x features do not fit it, see ``nested_scores``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.models.trees import NodeTable
from millrace.session import materialize

BINS = 32
MOST_CELLS = 128 << 20
# values that a task hands on to choose the bins of a feature: its share of each is off by this part at most
POINTS = 2048
BLOCK_ROWS = 65_536
# nodes whose histograms a task holds at once
MOST_NODES = 1024
LEAST_GAIN = 1e-12

# Poisson(1) by 16 random bits
_CHANCES = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
_COUNTS = np.searchsorted(_CHANCES, (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


def points_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their counts; of more than ``POINTS``, so many that stand for the values up to them."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= POINTS:
        return found, counts
    upto = np.cumsum(counts)
    kept = np.unique(np.searchsorted(upto, np.linspace(0, upto[-1], POINTS + 1)[1:]))
    return found[kept], np.diff(upto[kept], prepend=0)


def thresholds(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Ascending splits into at most ``BINS`` bins of about the same count, halfway between neighbouring values."""
    found, back = np.unique(values, return_inverse=True)
    halfway = (found[:-1] + found[1:]) / 2
    if len(found) <= BINS:
        return halfway
    upto = np.cumsum(np.bincount(back, counts))
    wanted = upto[-1] * np.arange(1, BINS) / BINS
    after = np.clip(np.searchsorted(upto, wanted), 1, len(found) - 1)
    nearest = np.where(wanted - upto[after - 1] < upto[after] - wanted, after - 1, after)
    return halfway[np.unique(np.minimum(nearest, len(halfway) - 1))]


def coded(points: np.ndarray, labels: np.ndarray, splits: Sequence[np.ndarray]) -> np.ndarray:
    """Features x rows: twice the bin of a value, plus the class."""
    out = np.empty((points.shape[1], len(points)), dtype=np.uint8)
    for f, cuts in enumerate(splits):
        out[f] = 2 * np.searchsorted(cuts, points[:, f], side="left") + labels
    return out


def drawn(nodes: np.ndarray, n_features: int, n_drawn: int, key: int) -> np.ndarray:
    """Ascending features of each node, from its number alone: the first of an order by hashes (splitmix)."""
    x = nodes[:, None] * np.uint64(n_features) + np.arange(n_features, dtype=np.uint64) + np.uint64(key)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.sort(np.argsort(x, axis=1)[:, :n_drawn], axis=1)


class Nodes:
    """The nodes of one tree in the order they are met; a leaf is its own child."""

    def __init__(self) -> None:
        self.feature, self.split, self.left, self.right, self.share = [], [], [], [], []

    def add(self, share: float) -> int:
        place = len(self.share)
        self.feature.append(0)
        self.split.append(math.inf)
        self.left.append(place)
        self.right.append(place)
        self.share.append(share)
        return place


def grow(
    codes: np.ndarray, counts: np.ndarray, splits: Sequence[np.ndarray], leaves: Sequence[int], depth: int, n_drawn: int, key: int
) -> list[Nodes]:
    """One tree for each leaf size, from coded rows and how often each is in the tree's sample."""
    trees = [Nodes() for _ in leaves]
    rows = np.flatnonzero(counts)
    width = 2 * BINS * (int(counts.max(initial=0)) + 1)
    steps = np.arange(width // (2 * BINS), dtype=float)
    shift = counts.astype(np.uint16) * np.uint16(2 * BINS)
    ones, n = float((codes[0] & 1)[rows] @ counts[rows].astype(float)), float(counts.sum())
    root = ones / n if n else float((codes[0] & 1).mean())
    open_nodes = [(1, rows, {v: t.add(root) for v, t in enumerate(trees) if 0 < ones < n and n >= 2 * leaves[v]})]
    for t in trees:
        if not t.share:
            t.add(root)
    for level in range(depth):
        open_nodes = [node for node in open_nodes if node[2]]
        if not open_nodes:
            break
        further = []
        for begin in range(0, len(open_nodes), MOST_NODES):
            some = open_nodes[begin : begin + MOST_NODES]
            numbers = np.array([node[0] for node in some], dtype=np.uint64)
            features = drawn(numbers, len(codes), n_drawn, key)
            seen = np.empty((len(some), n_drawn, width))
            for s, (_, rows, _) in enumerate(some):
                times = shift.take(rows, mode="clip")
                for k, f in enumerate(features[s].tolist()):
                    seen[s, k] = np.bincount(codes[f].take(rows, mode="clip") + times, minlength=width)
            seen = np.einsum("skwc,w->skc", seen.reshape(len(some), n_drawn, -1, 2 * BINS), steps)
            below = seen.reshape(len(some), n_drawn, BINS, 2).cumsum(axis=2)
            above = below[:, :, -1:] - below
            n_below, n_above = below.sum(axis=3), above.sum(axis=3)
            total = below[:, :1, -1]
            n_total = total.sum(axis=2)[:, :, None]
            pure = (below**2).sum(axis=3) / np.maximum(n_below, 1) + (above**2).sum(axis=3) / np.maximum(n_above, 1)
            gain = (pure - (total**2).sum(axis=2)[:, :, None] / n_total) / n_total
            gain[gain <= LEAST_GAIN] = 0.0
            best = []
            for leaf in leaves:
                allowed = np.where((n_below >= leaf) & (n_above >= leaf), gain, 0.0).reshape(len(some), -1)
                at = allowed.argmax(axis=1)
                best.append(np.where(allowed[np.arange(len(at)), at] > 0, at, -1).tolist())
            for s, (number, rows, places) in enumerate(some):
                ways: dict[int, list[int]] = {}
                for v in places:
                    if best[v][s] >= 0:
                        ways.setdefault(best[v][s], []).append(v)
                for way, those in ways.items():
                    k, cut = divmod(way, BINS)
                    f = int(features[s, k])
                    sides = []
                    for side in (below, above):
                        zero, one = side[s, k, cut].tolist()
                        sides.append((one / (zero + one), zero + one if zero and one else 0.0))
                    children: tuple[dict, dict] = ({}, {})
                    for v in those:
                        t, p = trees[v], places[v]
                        t.feature[p], t.split[p] = f, float(splits[f][cut])
                        t.left[p], t.right[p] = ends = t.add(sides[0][0]), t.add(sides[1][0])
                        for child, end, (_, mixed) in zip(children, ends, sides):
                            if mixed >= 2 * leaves[v]:
                                child[v] = end
                    if level + 1 < depth and (children[0] or children[1]):
                        left = codes[f].take(rows, mode="clip") < 2 * cut + 2
                        if children[0]:
                            further.append((2 * number, rows.compress(left), children[0]))
                        if children[1]:
                            further.append((2 * number + 1, rows.compress(~left), children[1]))
        open_nodes = further
    return trees


def table_of(trees: Sequence[Nodes]) -> dict[str, np.ndarray]:
    """The trees end to end, as the fields of a ``NodeTable``."""
    sizes = np.array([len(t.share) for t in trees])
    roots = np.cumsum(sizes) - sizes

    def joined(name: str, kind: type, base: bool = False) -> np.ndarray:
        return np.concatenate([np.array(getattr(t, name), dtype=kind) + (kind(r) if base else kind(0)) for t, r in zip(trees, roots)])

    return {
        "roots": roots.astype(np.int64),
        "feature": joined("feature", np.int32),
        "split": joined("split", np.float64),
        "left": joined("left", np.int32, True),
        "right": joined("right", np.int32, True),
        "share": joined("share", np.float64),
    }


def put_together(parts: Sequence[dict[str, np.ndarray]]) -> NodeTable:
    """One forest from the tables of its groups of trees."""
    sizes = np.array([len(p["share"]) for p in parts])
    begin = np.cumsum(sizes) - sizes
    return NodeTable(
        **{
            name: np.concatenate([p[name] + (b if name in ("roots", "left", "right") else 0) for p, b in zip(parts, begin)]).astype(kind)
            for name, kind in _KINDS.items()
        }
    )


_KINDS = {"roots": np.int64, "feature": np.int32, "split": np.float64, "left": np.int32, "right": np.int32, "share": np.float64}


def points_in(batch: pa.RecordBatch) -> np.ndarray:
    """Rows x features of the list column ``x``."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def by_fold(batches: Iterator[pa.RecordBatch]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Points and classes of a task's rows."""
    found: dict[int, list] = {}
    for batch in batches:
        folds = batch.column("fold").to_numpy()
        points, labels = points_in(batch) if batch.num_rows else None, batch.column("label").to_numpy(zero_copy_only=False)
        for fold in np.unique(folds).tolist():
            here = folds == fold
            found.setdefault(fold, []).append((points[here], labels[here]))
    return {fold: (np.concatenate([p for p, _ in parts]), np.concatenate([y for _, y in parts])) for fold, parts in found.items()}


class FoldRows:
    """The rows that forests are grown from: one frame for all folds, with what chooses their bins."""

    def __init__(self, fit_rows: dict[int, DataFrame], label: str) -> None:
        self.rows = reduce(
            DataFrame.unionByName,
            [
                rows.select(F.lit(fold).alias("fold"), vector_to_array("features").alias("x"), F.col(label).cast("int").alias("label"))
                for fold, rows in fit_rows.items()
            ],
        )

        def summarized(batches):
            for fold, (points, _) in by_fold(batches).items():
                for f in range(points.shape[1]):
                    values, counts = points_of(points[:, f])
                    yield pa.RecordBatch.from_pydict(
                        {"fold": [fold], "feature": [f], "values": [values.tolist()], "counts": [counts.tolist()]}, schema=kind
                    )

        kind = pa.schema(
            [("fold", pa.int32()), ("feature", pa.int32()), ("values", pa.list_(pa.float64())), ("counts", pa.list_(pa.int64()))]
        )
        parts: dict[tuple[int, int], list] = {}
        for r in self.rows.mapInArrow(summarized, "fold int, feature int, values array<double>, counts array<bigint>").collect():
            parts.setdefault((r["fold"], r["feature"]), []).append((np.array(r["values"]), np.array(r["counts"])))
        # a fold that lacks a category has fewer features
        self.splits: dict[int, list[np.ndarray]] = {}
        for fold, f in sorted(parts):
            self.splits.setdefault(fold, []).append(thresholds(*(np.concatenate(side) for side in zip(*parts[fold, f]))))
        sizes = {fold: sum(int(counts.sum()) for _, counts in found) for (fold, f), found in parts.items() if f == 0}
        self.cells = max((len(splits) * sizes[fold] for fold, splits in self.splits.items()), default=0)

    def blocks(self) -> DataFrame:
        """The rows in bins, stored some ten thousand together."""
        splits = self.splits

        def packed(batches):
            part = TaskContext.get().partitionId()
            for fold, (points, labels) in by_fold(batches).items():
                for number, i in enumerate(range(0, len(points), BLOCK_ROWS)):
                    codes = coded(points[i : i + BLOCK_ROWS], labels[i : i + BLOCK_ROWS], splits[fold])
                    yield pa.RecordBatch.from_pydict(
                        {"fold": pa.array([fold], pa.int32()), "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                         "codes": pa.array([codes.tobytes()], pa.binary())}
                    )

        return materialize(self.rows.mapInArrow(packed, "fold int, part int, number int, codes binary"), "blocks")

    def forests(self, leaves: Sequence[int], depth: int, trees: int, seed: int) -> dict[tuple[int, int], NodeTable]:
        """A forest for each fold and leaf size. Each fold takes as many tasks as make whole waves of all."""
        splits = self.splits
        slots = self.rows.sparkSession.sparkContext.defaultParallelism
        groups = min(trees, slots // math.gcd(slots, len(splits)))
        folds = sorted(splits)

        def grown(batches):
            parts, fold, group = {}, None, None
            for batch in batches:
                for r in range(batch.num_rows):
                    fold, group, part, number = (batch.column(c)[r].as_py() for c in ("fold", "group", "part", "number"))
                    parts[part, number] = np.frombuffer(batch.column("codes")[r].as_py(), dtype=np.uint8).reshape(len(splits[fold]), -1)
            if not parts:
                return
            n_drawn = math.ceil(math.sqrt(len(splits[fold])))
            codes = np.concatenate([parts.pop(k) for k in sorted(parts)], axis=1)
            found: list[list[Nodes]] = [[] for _ in leaves]
            for tree in range(group, trees, groups):
                draw = np.random.default_rng([seed % 2**64, fold, tree])
                counts = _COUNTS[draw.integers(0, 65_536, codes.shape[1], dtype=np.uint16)]
                for own, t in zip(found, grow(codes, counts, splits[fold], leaves, depth, n_drawn, int(draw.integers(0, 2**62)))):
                    own.append(t)
            for leaf, own in enumerate(found):
                table = {name: [column.tobytes()] for name, column in table_of(own).items()}
                yield pa.RecordBatch.from_pydict(
                    {"fold": pa.array([fold], pa.int32()), "leaf": pa.array([leaf], pa.int32()), "group": pa.array([group], pa.int32())} | table
                )

        dealt = (
            self.blocks()
            .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
            .withColumn("place", F.array_position(F.array(*(F.lit(f) for f in folds)), F.col("fold")) - 1)
            .repartitionById(len(folds) * groups, (F.col("place") * groups + F.col("group")).cast("int"))
        )
        schema = "fold int, leaf int, group int, " + ", ".join(f"{name} binary" for name in _KINDS)
        tables: dict[tuple[int, int], list] = {}
        for r in sorted(dealt.mapInArrow(grown, schema).collect(), key=lambda r: r["group"]):
            tables.setdefault((r["fold"], leaves[r["leaf"]]), []).append({name: np.frombuffer(r[name], dtype=kind) for name, kind in _KINDS.items()})
        return {key: put_together(parts) for key, parts in tables.items()}
