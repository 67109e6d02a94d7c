"""Mixing sources to target weights with soft domain membership.

A classifier learned from the labels table gives each document its posterior over the
domains ``clean``, ``junk`` (quality 0) and ``toxic``. Non-negative rates are then fitted
so that the expected tokens of each domain, the sum of rate * tokens * posterior, match
targets: accelerated projected gradient on

    sum_k (S_k - T_k)^2 / (2 T_k)  +  RIDGE / 2 * sum_d tokens_d * (rate_d - 1)^2

in the metric of the tokens, where a step moves a document's rate by
``sum_k posterior_k (S_k - T_k) / T_k + RIDGE (rate - 1)``. The only thing the documents
share is the vector of domain totals: a step is one aggregation of few numbers, and every
task replays the steps so far from that short list, so no rate is stored or sent. Targets are
the weights times a total that is the largest for which no domain has to be repeated,
times ``HEADROOM``.

Dropping rows to reach weights (``resampled``) is fitted otherwise: the total comes from the clean
text, and only documents led by a domain above its target may fall below rate 1. A scarce
domain is kept whole and never scales the others down; so is all text if the labels tell nothing.

The classifier (multinomial logistic over byte and byte-pair counts, telling word beginnings, word length and repetition) is fitted on the
driver from at most ``TRAIN_DOCUMENTS`` labelled rows per domain and ``TRAIN_CHARS`` characters, in order of a
hash of doc_id; everything else covers every row. Tokens are words between ASCII blanks.

Null and empty texts have no tokens and keep a rate like any other. Of contradicting labels of
one doc_id the larger counts; null labels are left out. Repeated rows are documents each.
With no labels every posterior is uniform; an empty table gives an empty result. A domain
without any expected token is left out of the fit. Extra columns are ignored.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import mark, slices, stored, table, utf8
from millrace.llm.toxicity import words_of

DOMAINS = ("clean", "junk", "toxic")
NAMES = [f"p_{d}" for d in DOMAINS]
WEIGHTS = {"clean": 0.94, "junk": 0.05, "toxic": 0.01}
TRAIN_DOCUMENTS, TRAIN_CHARS = 1500, 6_000_000
PAIRS = 1024
BEGINNING, BUCKETS = 5, 1 << 16
RIDGE, STEPS, TOLERANCE, HEADROOM = 1e-3, 40, 1e-4, 1.1
SIZE = 256 + PAIRS + 8  # features of a text
BLOCK_ROWS = 512  # texts whose features a task holds at once


def beginnings(text: bytes) -> np.ndarray:
    """Hashes of the first ``BEGINNING`` bytes of all words."""
    starts = {w[:BEGINNING] for w in words_of(text)}
    return np.fromiter((zlib.crc32(x) % BUCKETS for x in starts), dtype=np.int64, count=len(starts))


def telling(texts: list[bytes], marked: np.ndarray) -> np.ndarray:
    """Which word beginnings speak for the marked texts: in at least four of them, and 20 times as likely as elsewhere."""
    counts = np.zeros((2, BUCKETS))
    for text, mark in zip(texts, marked):
        counts[int(mark), np.unique(beginnings(text))] += 1
    inside = (counts[1] + 0.5) / (marked.sum() + 1)
    outside = (counts[0] + 0.5) / ((~marked).sum() + 1)
    return (counts[1] >= 4) & (inside > 20 * outside)


def features(text: bytes, tells: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Fixed-length description of a whole text, from its bytes and words; written to ``out`` if given."""
    out = np.zeros(SIZE, dtype=np.float32) if out is None else out
    data = np.frombuffer(text, dtype=np.uint8)
    single = np.bincount(data, minlength=256)
    double = np.zeros(PAIRS)
    # a very long text is counted piece by piece, each with the byte before it
    for i in range(0, len(data) - 1, 1 << 20):
        wide = data[i : i + (1 << 20) + 1].astype(np.int32)
        double += np.bincount((wide[:-1] * 0x79B1 + wide[1:] * 0x2F) % PAIRS, minlength=PAIRS)
    words = text.split()
    repeated = 1 - len(set(words)) / len(words) if words else 0.0
    adjacent = sum(map(bytes.__eq__, words, words[1:])) / len(words) if words else 0.0
    told = int(tells[beginnings(text)].sum())
    extra = [float(told > 0), min(told, 6) / 6, np.log1p(len(data)) / 10, np.log1p(len(words)) / 10, len(data) / (len(words) + 1) / 10, repeated, adjacent * 3]
    out[:256] = np.sqrt(single / max(len(data), 1))
    out[256 : 256 + PAIRS] = np.sqrt(double / max(len(data), 1))
    out[256 + PAIRS :] = [*extra, 1.0]
    return out


def scored(texts: pa.Array, tells: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors and tokens of a batch of texts, over one small buffer of features."""
    p, tokens = np.empty((len(texts), len(DOMAINS))), np.empty(len(texts), dtype=np.int64)
    buffer = np.empty((min(BLOCK_ROWS, len(texts)), SIZE), dtype=np.float32)
    narrow = w.astype(np.float32)
    for i in range(0, len(texts), BLOCK_ROWS):
        block = texts.slice(i, BLOCK_ROWS).to_pylist()
        for k, text in enumerate(block):
            features(text, tells, buffer[k])
            tokens[i + k] = len(text.split())
        p[i : i + len(block)] = softmax((buffer[: len(block)] @ narrow).astype(np.float64))
    return p, tokens


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_classifier(
    texts: list[bytes], domains: list[int], rounds: int = 500, ridge: float = 1e-5
) -> tuple[np.ndarray, np.ndarray]:
    """Telling word beginnings, and weights (features x domains) by accelerated gradient descent.

    The beginnings are learned on every other text and the weights on the rest, which
    have not been seen by them.
    """
    if len(texts) < 2:
        return np.zeros(BUCKETS, dtype=bool), np.zeros((SIZE, len(DOMAINS)))
    tells = telling(texts[::2], np.array(domains[::2]) == len(DOMAINS) - 1)
    x = np.stack([features(t, tells) for t in texts[1::2]]).astype(np.float64)
    y = np.eye(len(DOMAINS))[domains[1::2]]
    w = ahead = np.zeros((SIZE, len(DOMAINS)))
    step = 2.0 / (np.linalg.norm(x, 2) ** 2 / len(x) + 2 * ridge)
    for i in range(rounds):
        new = ahead - step * (x.T @ (softmax(x @ ahead) - y) / len(x) + ridge * ahead)
        ahead, w = new + (i / (i + 3)) * (new - w), new
    return tells, w


def labelled_domains(labels: DataFrame) -> DataFrame:
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & F.col("toxic").isin(0, 1))
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    return known.groupBy("doc_id").agg(F.max(domain).alias("domain"))


def train(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return train_counted(documents, labels)[0]


def train_counted(documents: DataFrame, labels: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The classifier, and of how many texts of each domain its weights have learned."""
    marked = labelled_domains(labels)
    sized = documents.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("size")).join(marked, "doc_id")
    per_doc = sized.groupBy("doc_id", "domain").agg(F.max("size").alias("size"))
    counts = {r["domain"]: r["count"] for r in per_doc.groupBy("domain").count().collect()}
    chosen: list[tuple[int, int]] = []
    for k in range(len(DOMAINS)):
        order = per_doc.where(F.col("domain") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCUMENTS)
        held = 0
        for row in order.collect():
            if held + row["size"] <= TRAIN_CHARS:
                held += row["size"]
                chosen.append((row["doc_id"], k))
    if len(chosen) < 2:
        return fit_classifier([], []), np.zeros(len(DOMAINS), dtype=np.int64)
    keys = documents.sparkSession.createDataFrame(chosen, "doc_id bigint, domain int")
    rows = documents.select("doc_id", utf8().alias("body")).join(F.broadcast(keys), "doc_id")
    rows = rows.groupBy("doc_id", "domain").agg(F.max("body").alias("body")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    tells, w = fit_classifier([bytes(r["body"]) for r in rows], [r["domain"] for r in rows])
    # the sample is balanced by domain: put the shares of all labels back into the intercept
    taken = np.bincount([r["domain"] for r in rows[1::2]], minlength=len(DOMAINS))
    whole = np.array([counts.get(k, 0) for k in range(len(DOMAINS))], dtype=np.float64)
    shift = np.log((whole + 0.5) / whole.sum()) - np.log((taken + 0.5) / taken.sum())
    w[-1] += shift
    return (tells, w), taken


def posteriors(documents: DataFrame, classifier: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, n_tokens and the posterior of each domain, for every row."""
    shared = documents.sparkSession.sparkContext.broadcast(classifier)
    schema = "doc_id bigint, n_tokens bigint, " + ", ".join(f"p_{d} double" for d in DOMAINS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tells, w = shared.value
        for batch in slices(batches, "body"):
            p, tokens = scored(batch.column("body"), tells, w)
            columns = [batch.column("doc_id"), pa.array(tokens), *(pa.array(p[:, k]) for k in range(len(DOMAINS)))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", *(f"p_{d}" for d in DOMAINS)])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("body")).mapInArrow(run, schema)


def replayed(
    p: np.ndarray, errors: list[np.ndarray], step: float, ahead: bool = False, thinned: np.ndarray | None = None
) -> np.ndarray:
    """Rates after the steps whose relative domain errors are given, from 1.

    The steps are accelerated: errors belong to the point ahead of the rates, where momentum carries them.
    With ``thinned`` (one flag per domain) rates lie between 0 and 1 for documents led by such a domain and are 1 for others.
    """
    low, high = 0.0, np.inf
    if thinned is not None:
        low, high = np.where(thinned[p.argmax(axis=1)], 0.0, 1.0), 1.0
    rate = forward = np.ones(len(p))
    for i, e in enumerate(errors):
        new = np.clip(forward - step * (p @ e + RIDGE * (forward - 1)), low, high)
        forward, rate = new + (i / (i + 3)) * (new - rate), new
    return forward if ahead else rate


def rates_of(columns: list[str], errors: list[np.ndarray], step: float, ahead: bool = False, thinned: np.ndarray | None = None):
    @F.pandas_udf("double")
    def rate(*p: pd.Series) -> pd.Series:
        return pd.Series(replayed(np.stack([x.to_numpy() for x in p], axis=1), errors, step, ahead, thinned))

    return rate(*columns)


def shares_of(weights: dict[str, float]) -> np.ndarray:
    share = np.array([weights[d] for d in DOMAINS], dtype=np.float64)
    if (share < 0).any() or not share.sum():
        raise ValueError("weights must not be negative, nor all zero")
    return share / share.sum()


def totals(rows: DataFrame) -> np.ndarray:
    """Expected tokens of each domain at the rates of the rows."""
    sums = rows.agg(*(F.sum(F.col("rate") * F.col("n_tokens") * F.col(n)).alias(n) for n in NAMES)).first()
    return np.array([x or 0.0 for x in sums])


def descended(members: DataFrame, supply: np.ndarray, targets: np.ndarray, fitted: np.ndarray, thinned: np.ndarray | None = None) -> dict:
    """The fit of the rates to the targets of the fitted domains: targets, reached totals, steps taken, largest miss.

    A fit that has not met ``TOLERANCE`` after ``STEPS`` steps (targets that no rates reach, such as one domain that comes
    only inside documents of another) is returned with a warning that names the miss.
    """
    scale = np.where(fitted, targets, 1.0)
    step = 1.0 / (np.max(supply[fitted] / targets[fitted]) + RIDGE)
    errors: list[np.ndarray] = []
    reached = supply
    while len(errors) < STEPS:
        error = np.where(fitted, (reached - targets) / scale, 0.0)
        if np.abs(error).max() < TOLERANCE:
            break
        errors.append(error)
        reached = totals(members.withColumn("rate", rates_of(NAMES, errors, step, True, thinned)))
    reached = totals(members.withColumn("rate", rates_of(NAMES, errors, step, False, thinned)))
    off = float(np.abs(np.where(fitted, (reached - targets) / scale, 0.0)).max())
    if off >= TOLERANCE and len(errors) == STEPS:
        warnings.warn(f"the mixing fit ends after {STEPS} steps with a domain {off:.2%} off its target", stacklevel=2)
    return {"targets": targets, "reached": reached, "steps": len(errors), "errors": errors, "step": step, "off": off}


def fit_rates(members: DataFrame, weights: dict[str, float] = WEIGHTS, headroom: float = HEADROOM) -> tuple[DataFrame, dict]:
    """Members with ``rate``; and the fit: targets, reached totals, steps taken."""
    share = shares_of(weights)
    supply = totals(members.withColumn("rate", F.lit(1.0)))
    fitted = (share > 0) & (supply > 0)
    if not fitted.any():
        return members.withColumn("rate", F.lit(1.0)), {"targets": supply, "reached": supply, "steps": 0, "errors": [], "step": 0.0, "off": 0.0}
    total = headroom * np.min(supply[fitted] / share[fitted])
    fit = descended(members, supply, np.where(fitted, share * total, 0.0), fitted)
    return members.withColumn("rate", rates_of(NAMES, fit["errors"], fit["step"])), fit


def fit_thinning(members: DataFrame, weights: dict[str, float], known: np.ndarray) -> dict:
    """The fit whose rates lie between 0 and 1 and are 1 for all but documents led by a domain above its target.

    Targets are the weights over that of clean text, times the clean supply. ``known`` flags
    the domains that the classifier has seen: without clean text among them nothing is thinned, and no unseen
    domain is. A domain of weight 0 has no target and is left as it is.
    """
    share = shares_of(weights)
    supply = totals(members.withColumn("rate", F.lit(1.0)))
    targets, thinned = supply, np.zeros(len(DOMAINS), dtype=bool)
    if share[0] > 0 and supply[0] > 0 and known[0]:
        wanted = share / share[0] * supply[0]
        thinned = known & (wanted > 0) & (supply > wanted)
        thinned[0] = False
        targets = np.where(thinned, wanted, supply)
    if not thinned.any():
        return {"targets": supply, "reached": supply, "steps": 0, "errors": [], "step": 0.0, "off": 0.0, "thinned": thinned}
    return descended(members, supply, targets, thinned, thinned) | {"thinned": thinned}


def resampled(documents: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """The documents kept with the probability of ``fit_thinning``, by a hash of doc_id and text, with their own columns.

    No document is repeated, so that a stage before this one that removed copies stays
    true. Rates are replayed beside the texts: nothing is joined or shuffled. A task sends each text once and gets
    a flag back; rows and their other columns stay with Spark.
    """
    classifier, seen = train_counted(documents, labels)
    fit = fit_thinning(stored(posteriors(documents, classifier), "posteriors"), weights, seen > 0)
    if not fit["errors"]:
        return documents
    shared = documents.sparkSession.sparkContext.broadcast((classifier, fit["errors"], fit["step"], fit["thinned"]))

    @F.arrow_udf("boolean")
    def kept(body: pa.Array, draw: pa.Array) -> pa.Array:
        (tells, w), errors, step, thinned = shared.value
        keep = [np.zeros(0, dtype=bool)]
        for part in slices([pa.RecordBatch.from_arrays([body, draw], names=["body", "draw"])], "body"):
            p = scored(part.column("body"), tells, w)[0]
            keep.append(part.column("draw").to_numpy() < replayed(p, errors, step, thinned=thinned))
        return pa.array(np.concatenate(keep))

    uniform = F.pmod(F.xxhash64("doc_id", mark()), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return documents.where(kept(utf8(), uniform))


def mixed(documents: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, headroom: float = HEADROOM) -> tuple[DataFrame, dict]:
    members = stored(posteriors(documents, train(documents, labels)), "posteriors")
    return fit_rates(members, weights, headroom)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))[0]
