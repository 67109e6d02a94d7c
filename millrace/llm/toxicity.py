"""Toxicity: a bidirectional gated recurrent network with attention over overlapping windows.

Words (ASCII letters lower-cased, other ASCII signs are breaks) enter as a hashed word vector
beside the mean of hashed character n-gram vectors. Two gated recurrent layers read each window of
``WINDOW`` words, one from each end; attention pools their states to one logit. A
document's logit is the largest of all its windows, ``STRIDE`` words apart, to the end of
the text; a fitted slope and offset turn it into a score.

Trained in numpy on at most ``TRAIN_DOCUMENTS`` labelled rows of each class, together ``TRAIN_CHARS`` bytes a class (a
bound on the driver's memory; scoring has none), from rows outside the held-out fifth: texts of up to ``TRAIN_LONGEST``
bytes in order of a hash of doc_id, and where these are fewer than ``TRAIN_LEAST`` also longer ones, the
shorter first. A text that alone is longer than the bound gives ``TRAIN_CHARS`` / 8 characters from a place
drawn by a hash of its id. As labels hold for
documents and not for windows, training goes on with the window that scores highest in
its document, looked up anew every other pass. Every fifth of these rows is kept from the training and fits the slope and offset.
Labels, lang, source and doc_id are no inputs of a score.

Null text is empty; a text without words is one window of padding and gets the score of
that. Repeated rows are scored each. A null doc_id is held out. Labels that are null are
left out, of contradicting labels of one doc_id the larger counts. Without labels of both
classes every score is the constant share of label 1 (0 without labels). Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import WordIds, free_name, mix, table, with_bytes

WINDOW, STRIDE = 24, 12
TRAIN_DOCUMENTS, TRAIN_CHARS, TRAIN_LONGEST, TRAIN_LEAST = {0: 3000, 1: 2000}, 5_000_000, 6_000, 200
HIDDEN, WORD_DIM, CHAR_DIM = 8, 6, 6
WORD_BUCKETS, CHAR_BUCKETS = 1 << 14, 1 << 16
NGRAMS = (3, 4, 5, 6)
PASSES, LEAST_STEPS, BATCH, RATE, SEED = 8, 400, 128, 0.01, 7
CHUNK = 4096  # windows that run through the network together

_BREAKS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_BREAKS).split()


def inputs_of(words: list[bytes], step: int = 20_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, and character n-gram buckets with the count of each word, of distinct words."""
    parts = [_inputs(words[i : i + step]) for i in range(0, len(words), step)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\x02" + b"\x03\x02".join(words) + b"\x03", dtype=np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    room = ends[owner] - np.arange(len(data))  # characters from here to the end of the word
    position = (np.arange(len(data)) - (ends - lengths)[owner]).astype(np.uint64)
    with np.errstate(over="ignore"):
        whole = np.add.reduceat(mix(data + (position << np.uint64(8))), ends - lengths)
        rolling, grams, owners = np.zeros(len(data), dtype=np.uint64), [], []
        for n in range(1, max(NGRAMS) + 1):
            shifted = np.zeros(len(data), dtype=np.uint64)
            shifted[: max(len(data) - n + 1, 0)] = data[n - 1 :]
            rolling = rolling * np.uint64(0x100000001B3) + shifted + np.uint64(1)
            if n in NGRAMS:
                fits = np.flatnonzero(room >= n)
                grams.append((mix(rolling[fits]) % np.uint64(CHAR_BUCKETS)).astype(np.int32))
                owners.append(owner[fits])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return (mix(whole) % np.uint64(WORD_BUCKETS)).astype(np.int32), grams[order], np.bincount(owners, minlength=len(words))


def sums_by(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Row sums of consecutive runs; an empty run is zero."""
    out = np.zeros((len(counts), values.shape[1]), dtype=np.float32)
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        out[some] = np.add.reduceat(values, starts, axis=0)
    return out


def window_starts(n: int) -> np.ndarray:
    """Starts of the overlapping windows that cover n words."""
    return np.arange(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def window_table(sizes: np.ndarray, ids: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of every window of documents that lie behind each other, and its document."""
    counts = np.maximum(1, -(-(sizes - (WINDOW - STRIDE)) // STRIDE))
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.cumsum(counts) - counts
    start = (np.arange(counts.sum()) - first[owner]) * STRIDE
    at = start[:, None] + np.arange(WINDOW)
    inside = at < sizes[owner][:, None]
    flat = np.append(ids, pad).astype(np.int32)
    where = np.where(inside, at + (np.cumsum(sizes) - sizes)[owner][:, None], len(ids))
    return flat[where], owner


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Parameters by name; both directions share one pass with a leading axis of two."""

    def __init__(self, parameters: dict[str, np.ndarray]) -> None:
        self.p = parameters

    @staticmethod
    def fresh(rng: np.random.Generator) -> dict[str, np.ndarray]:
        x = WORD_DIM + CHAR_DIM

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return {
            "word": normal(WORD_BUCKETS, WORD_DIM, scale=0.05),
            "char": normal(CHAR_BUCKETS, CHAR_DIM, scale=0.05),
            "wx": normal(2, x, 3 * HIDDEN, scale=x**-0.5),
            "bx": np.zeros((2, 1, 3 * HIDDEN), dtype=np.float32),
            "wh": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "att": normal(2, HIDDEN, scale=0.3),
            "out": normal(2, HIDDEN, scale=0.5),
            "b": np.full(1, -3.0, dtype=np.float32),  # nothing read yet is no evidence
        }

    def embed(self, inputs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Vectors of distinct words; a last row of zeros is the padding."""
        word, grams, counts = inputs
        parts = []
        step = 1 << 14
        ends = np.cumsum(counts)
        for i in range(0, len(word), step):
            j = min(i + step, len(word))
            begin, end = (ends[i - 1] if i else 0), ends[j - 1]
            chars = sums_by(self.p["char"][grams[begin:end]], counts[i:j]) / np.maximum(counts[i:j], 1)[:, None]
            parts.append(np.concatenate([self.p["word"][word[i:j]], chars], axis=1))
        return np.concatenate([*parts, np.zeros((1, WORD_DIM + CHAR_DIM), dtype=np.float32)]).astype(np.float32)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Input share of all gates of both directions, per distinct word."""
        return vectors @ self.p["wx"] + self.p["bx"]

    def run(self, projected: np.ndarray, windows: np.ndarray, pad: int, keep: bool = False):
        """Logit of each window; with ``keep`` also what the backward pass needs."""
        n, h = len(windows), HIDDEN
        state = np.zeros((2, n, h), dtype=np.float32)
        states = np.zeros((2, WINDOW, n, h), dtype=np.float32)
        masks = windows != pad
        trail = []
        for t in range(WINDOW):
            at = (t, WINDOW - 1 - t)
            x = np.stack([projected[0][windows[:, at[0]]], projected[1][windows[:, at[1]]]])
            u = state @ self.p["wh"]
            gates = sigmoid(x[:, :, : 2 * h] + u[:, :, : 2 * h])
            z, r = gates[:, :, :h], gates[:, :, h:]
            c = np.tanh(x[:, :, 2 * h :] + r * u[:, :, 2 * h :])
            live = np.stack([masks[:, at[0]], masks[:, at[1]]])[:, :, None]
            new = np.where(live, c + z * (state - c), state)
            if keep:
                trail.append((state, z, r, c, u[:, :, 2 * h :], live))
            state = new
            states[0, at[0]], states[1, at[1]] = new[0], new[1]
        energy = np.einsum("dtnh,dh->tn", states, self.p["att"], optimize=True)
        energy = np.where(masks.T, energy, np.float32(-1e9))
        energy -= energy.max(axis=0)
        weight = np.exp(energy) * masks.T
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,dtnh->dnh", weight, states, optimize=True)
        logit = np.einsum("dnh,dh->n", pooled, self.p["out"], optimize=True) + self.p["b"]
        return (logit, (states, weight, pooled, trail, masks)) if keep else logit

    def logits(self, projected: np.ndarray, windows: np.ndarray, pad: int) -> np.ndarray:
        parts = [self.run(projected, windows[i : i + CHUNK], pad) for i in range(0, len(windows), CHUNK)]
        return np.concatenate(parts)

    def gradients(self, inputs, windows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over windows of the given distinct words."""
        h, pad = HIDDEN, len(inputs[0])
        vectors = self.embed(inputs)
        logit, (states, weight, pooled, trail, masks) = self.run(self.project(vectors), windows, pad, keep=True)
        d = ((sigmoid(logit) - target) / len(target)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["b"][0] = d.sum()
        g["out"] = np.einsum("n,dnh->dh", d, pooled)
        dpooled = d[None, :, None] * self.p["out"][:, None, :]
        dweight = np.einsum("dnh,dtnh->tn", dpooled, states, optimize=True)
        denergy = weight * (dweight - (weight * dweight).sum(axis=0))
        g["att"] = np.einsum("tn,dtnh->dh", denergy, states, optimize=True)
        dstates = weight[None, :, :, None] * dpooled[:, None] + denergy[None, :, :, None] * self.p["att"][:, None, None, :]
        carry = np.zeros((2, len(windows), h), dtype=np.float32)
        dprojected = np.zeros((2, pad + 1, 3 * h), dtype=np.float32)
        for t in range(WINDOW - 1, -1, -1):
            state, z, r, c, un, live = trail[t]
            at = (t, WINDOW - 1 - t)
            carry = carry + np.stack([dstates[0, at[0]], dstates[1, at[1]]])
            through = np.where(live, carry, 0)
            dc = through * (1 - z) * (1 - c * c)
            dz = through * (state - c) * z * (1 - z)
            dr = dc * un * r * (1 - r)
            dx = np.concatenate([dz, dr, dc], axis=2)
            du = np.concatenate([dz, dr, dc * r], axis=2)
            g["wh"] += np.einsum("dnh,dnk->dhk", state, du, optimize=True)
            for k in (0, 1):
                np.add.at(dprojected[k], windows[:, at[k]], dx[k])
            carry = np.where(live, through * z, carry) + du @ self.p["wh"].transpose(0, 2, 1)
        dprojected[:, pad] = 0
        g["bx"] = dprojected.sum(axis=1, keepdims=True)
        g["wx"] = np.einsum("vx,dvk->dxk", vectors, dprojected, optimize=True)
        dvectors = np.einsum("dvk,dxk->vx", dprojected, self.p["wx"], optimize=True)[:pad]
        word, grams, counts = inputs
        np.add.at(g["word"], word, dvectors[:, :WORD_DIM])
        share = dvectors[:, WORD_DIM:] / np.maximum(counts, 1)[:, None]
        np.add.at(g["char"], grams, np.repeat(share, counts, axis=0))
        return g


def picked(inputs, chosen: np.ndarray):
    """Inputs of some of the distinct words."""
    word, grams, counts = inputs
    starts = np.cumsum(counts) - counts
    own = counts[chosen]
    at = np.repeat(starts[chosen] - (np.cumsum(own) - own), own) + np.arange(own.sum())
    return word[chosen], grams[at], own


def evidence(
    inputs, sizes: np.ndarray, ids: np.ndarray, target: np.ndarray, aside: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of each word and n-gram bucket by the documents of either class that hold it."""
    held = [np.zeros((2, WORD_BUCKETS), np.int32), np.zeros((2, CHAR_BUCKETS), np.int32)]
    starts, ends = np.cumsum(inputs[2]) - inputs[2], np.cumsum(sizes)
    for end, size, mark, skip in zip(ends, sizes, target, aside):
        if not skip and size:
            own = np.unique(ids[end - size : end])
            counts = inputs[2][own]
            at = np.repeat(starts[own] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            held[0][mark, np.unique(inputs[0][own])] += 1
            held[1][mark, np.unique(inputs[1][at])] += 1
    positive, negative = target[~aside].sum(), (1 - target[~aside]).sum()
    out = []
    for zero, one in held:
        odds = np.log((one + 0.5) / (positive + 1)) - np.log((zero + 0.5) / (negative + 1))
        out.append(np.where(one + zero > 1, np.clip(odds / 4, -1, 1), 0).astype(np.float32))  # seen once says little
    return out[0], out[1]


def train(texts: list[bytes], labels: list[int], seed: int = SEED, passes: int = PASSES) -> dict[str, np.ndarray]:
    """Parameters of the network and the scale of its scores. Works on the given texts only."""
    rng = np.random.default_rng(seed)
    target = np.asarray(labels, dtype=np.int64)
    if not len(target) or target.min() == target.max():
        share = float(target.mean()) if len(target) else 0.0
        return {"constant": np.array([share], dtype=np.float64)}
    known = WordIds()
    parts = [np.array([known[w] for w in words_of(x)], dtype=np.int32) for x in texts]
    sizes = np.array([len(x) for x in parts], dtype=np.int64)
    ids = np.concatenate(parts)
    inputs = inputs_of(list(known) or [b"\x00"])
    pad = len(inputs[0])
    windows, owner = window_table(sizes, ids, pad)
    aside = np.arange(len(target)) % 5 == 4  # these only fit the scale
    if len(np.unique(target[aside])) < 2 or len(np.unique(target[~aside])) < 2:
        aside[:] = False
    learned = ~aside[owner]
    parameters = Network.fresh(rng)
    parameters["word"][:, 0], parameters["char"][:, 0] = evidence(inputs, sizes, ids, target, aside)
    network = Network(parameters)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in parameters.items()}
    vectors = network.embed(inputs)
    signal = np.append(np.maximum(vectors[:pad, 0], 0) + vectors[:pad, WORD_DIM], 0)
    rank = signal[windows].max(axis=1)
    step = 0
    passes = max(passes, min(5 * passes, -(-LEAST_STEPS * BATCH // (3 * len(target)))))
    for turn in range(passes):
        if turn in (1, 2) or turn > 2 and turn % 2 == 0:
            rank = network.logits(network.project(network.embed(inputs)), windows, pad)
        order = np.lexsort((-rank, owner))
        tops = order[np.unique(owner[order], return_index=True)[1]]
        tops = tops[learned[tops]]
        others = rng.permutation(np.flatnonzero((target[owner] == 0) & learned))[: 2 * len(tops)]
        chosen = np.concatenate([tops, others])
        shown, want = windows[chosen], (target[owner[chosen]] == 1).astype(np.int64)
        # some clean windows are cut to a few words or none, so that short and empty texts are known as clean
        short = len(tops) + np.arange(0, len(others), 4)
        shown[short] = np.where(np.arange(WINDOW) < rng.integers(0, WINDOW, len(short))[:, None], shown[short], pad)
        shown[short[::8]] = pad
        shuffled = rng.permutation(len(chosen))
        for i in range(0, len(shuffled), BATCH):
            part = shuffled[i : i + BATCH]
            used, local = np.unique(shown[part], return_inverse=True)
            real = used[used < pad]
            g = network.gradients(picked(inputs, real), local.reshape(-1, WINDOW), want[part])
            step += 1
            rate = RATE * min(1.0, step / 20) * (1 - 0.8 * turn / passes)
            for k, v in parameters.items():
                m, s = moments[k]
                m += 0.1 * (g[k] - m)
                s += 0.001 * (g[k] * g[k] - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-7)
    logits = network.logits(network.project(network.embed(inputs)), windows, pad)
    top = np.full(len(sizes), -np.inf)
    np.maximum.at(top, owner, logits)
    fit = aside if aside.any() else ~aside
    parameters["scale"] = calibrated(top[fit], target[fit])
    return parameters


def calibrated(top: np.ndarray, target: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Slope and offset of a logistic curve through the documents' largest logits (ridge on the slope)."""
    x = np.stack([top, np.ones_like(top)])
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = sigmoid(np.clip(w @ x, -30, 30))
        gradient = x @ (p - target) / len(top) + np.array([1e-3 * (w[0] - 1), 0])
        curve = (x * (p * (1 - p))) @ x.T / len(top) + np.diag([1e-3, 1e-6])
        move = np.linalg.solve(curve, gradient)
        w -= np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    return w


def score_texts(parameters: dict[str, np.ndarray], texts: list[bytes]) -> np.ndarray:
    """Score of each whole text."""
    if "constant" in parameters:
        return np.full(len(texts), parameters["constant"][0])
    network, known = Network(parameters), WordIds()
    sizes, parts = [], []
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        parts.append(np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words)))
    ids = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
    pad = len(known)
    projected = network.project(network.embed(inputs_of(list(known)))) if pad else network.project(
        np.zeros((1, WORD_DIM + CHAR_DIM), dtype=np.float32)
    )
    windows, owner = window_table(np.array(sizes, dtype=np.int64), ids, pad)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, owner, network.logits(projected, windows, pad))
    slope, offset = parameters["scale"]
    return sigmoid(np.clip(slope * top + offset, -30, 30))


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 5; null is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def training_rows(documents: DataFrame, labels: DataFrame) -> tuple[list[bytes], list[int]]:
    """The bounded sample: rows outside the held-out fifth, in order of a hash of their id."""
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(fold(F.col("doc_id")) != 0)
    sized = documents.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("size")).join(marked, "doc_id")
    per_doc = sized.groupBy("doc_id", "toxic").agg(F.max("size").alias("size"))
    chosen: list[tuple[int, int]] = []
    for label in (0, 1):
        own = per_doc.where(F.col("toxic") == label)
        short = own.where(F.col("size") <= TRAIN_LONGEST).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCUMENTS[label])
        candidates = short.collect()
        if len(candidates) < TRAIN_LEAST:
            longer = own.where(F.col("size") > TRAIN_LONGEST).orderBy("size", F.xxhash64("doc_id"), "doc_id")
            candidates += longer.limit(TRAIN_LEAST - len(candidates)).collect()
        held = 0
        for row in candidates:
            size = min(row["size"], TRAIN_CHARS // 2)
            if held + size <= TRAIN_CHARS:
                held += size
                chosen.append((row["doc_id"], label))
    if not chosen:
        return [], []
    keys = documents.sparkSession.createDataFrame(chosen, "doc_id bigint, toxic int")
    rows = documents.select("doc_id", excerpt().alias("body")).join(F.broadcast(keys), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.max("body").alias("body")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    return [bytes(r["body"]) for r in rows], [r["toxic"] for r in rows]


def excerpt() -> Column:
    """The whole text as bytes; of one beyond the bound a piece from a drawn place."""
    text = F.coalesce(F.col("text"), F.lit(""))
    length = TRAIN_CHARS // 8
    start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.char_length(text) - length)).cast("int") + 1
    return F.when(F.octet_length(text) <= TRAIN_CHARS // 2, text).otherwise(F.substring(text, start, F.lit(length))).cast("binary")


def fitted(documents: DataFrame, labels: DataFrame) -> dict[str, np.ndarray]:
    return train(*training_rows(documents, labels))


def scored(documents: DataFrame, parameters: dict[str, np.ndarray], name: str = "toxicity_score") -> DataFrame:
    """The documents' own columns and the score as ``name``, which must be new; every window of every text is scored."""
    if name.lower() in (c.lower() for c in documents.columns):
        raise ValueError(f"the documents have a column {name}")
    shared = documents.sparkSession.sparkContext.broadcast(parameters)
    own = documents.schema.fields
    frame = documents.select(*(F.col(f"`{f.name}`") for f in own))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own) + f", {name} double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bodies in with_bytes(batches, 4 << 20):
            scores = score_texts(shared.value, bodies.to_pylist())
            columns = [batch.column(f.name) for f in own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, type=pa.float64())], names=[*(f.name for f in own), name])

    return frame.mapInArrow(run, schema)


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose score stays below the threshold, with their own columns."""
    name = free_name(documents, "toxicity_score")
    return scored(documents, fitted(documents, labels), name).where(F.col(name) < threshold).drop(name)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    parameters = fitted(documents, table(spark, sf_dir, "labels"))
    rows = scored(documents, parameters)
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"),
    )
