"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces come from a public model file, whose path is a parameter. That file orders its
pieces by merge rank and holds no probabilities, so a piece's log score is taken from its
rank by Zipf's law, ``-log(rank)`` less the log of the ranks' harmonic sum. A text is encoded to the
pieces with the largest sum of log scores; a character that no piece covers costs the
smallest score less ``UNKNOWN_PENALTY`` and becomes its UTF-8 bytes. Blanks become the
marker U+2581, one of which is put in front of the text; decoding undoes both.

Since no piece has a marker behind another character, a best path of a text is made of
best paths of its words. Each slice of a partition therefore runs the search once per
distinct word, all words of like length together in numpy, and puts texts together from
the results. The trie is built once on the driver from the (bounded) model and broadcast.

A null text is empty and has no pieces. A marker in the text itself decodes as a blank, as
in any such codec. Ties of the sum go to the longest last piece. Repeated rows are encoded
each; an empty table gives an empty result; other columns pass unchanged, except ones
named like the results, which are replaced. Texts of any length are encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import WordIds, ragged, table, with_bytes

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁".encode()
UNKNOWN_PENALTY = 10.0
LONGEST = 64  # bytes of a word searched side by side with others; longer ones go one by one
WIDTHS = (6, 9, 12, 16, 24, 36, LONGEST)
SIDE_BY_SIDE = 1 << 13  # words whose tables a task holds at once, 10 MB at the largest width

# Kinds of pieces in the public model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def read_model(path: str = MODEL_PATH) -> list[tuple[str, int]]:
    """Text and kind of each piece, by id."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    model = schema.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return [(p.piece, p.type) for p in model.pieces]


def zipf_scores(pieces: list[tuple[str, int]]) -> np.ndarray:
    ranks = np.cumsum([kind == NORMAL for _, kind in pieces])
    return -np.log(np.maximum(ranks, 1)) - np.log(np.sum(1.0 / np.arange(1, max(ranks[-1], 1) + 1)))


def double_array(keys: list[bytes], values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of a trie over bytes; a child of ``s`` by byte ``c`` is ``base[s] + c``."""
    order = sorted(range(len(keys)), key=keys.__getitem__)
    size = 1 << 20
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = np.zeros(size, dtype=bool)
    used[0] = True
    free = 1
    work = [(0, 0, len(order), 0)]  # node, range of keys, depth
    while work:
        node, begin, end, depth = work.pop()
        while begin < end and len(keys[order[begin]]) == depth:
            value[node] = values[order[begin]]
            begin += 1
        if begin == end:
            continue
        children, starts = [], []
        for i in range(begin, end):
            c = keys[order[i]][depth]
            if not children or children[-1] != c:
                children.append(c)
                starts.append(i)
        while used[free]:
            free += 1
        at = max(free - children[0], 1)
        while True:
            if at + 4096 + 256 > size:
                base, check, value, used = (
                    np.concatenate([x, np.full(size, v, x.dtype)]) for x, v in ((base, 0), (check, -1), (value, -1), (used, False))
                )
                size *= 2
            taken = used[at + children[0] : at + children[0] + 4096].copy()
            for c in children[1:]:
                taken |= used[at + c : at + c + 4096]
            fit = int(np.argmin(taken))
            if not taken[fit]:
                at += fit
                break
            at += 4096
        base[node] = at
        for k, c in enumerate(children):
            used[at + c] = True
            check[at + c] = node
            work.append((at + c, starts[k], starts[k + 1] if k + 1 < len(starts) else end, depth + 1))
    top = int(np.flatnonzero(used)[-1])
    return tuple(x[: top + 257].copy() for x in (base, check, value))


class Codec:
    """Encoder and decoder of one vocabulary. Holds arrays only, so it broadcasts cheaply."""

    def __init__(self, pieces: list[tuple[str, int]], scores: np.ndarray | None = None) -> None:
        self.scores = np.asarray(zipf_scores(pieces) if scores is None else scores, dtype=np.float64)
        entries = [(text.encode(), i) for i, (text, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED) and text]
        if any(MARKER in key.lstrip(MARKER) for key, _ in entries if not key.startswith(MARKER)) or any(
            MARKER in _after_markers(key) for key, _ in entries
        ):
            raise ValueError("a piece has a marker behind another character")
        self.base, self.check, self.value = double_array([k for k, _ in entries], [i for _, i in entries])
        known = [i for _, i in entries]
        self.unknown_score = float(self.scores[known].min() if known else 0.0) - UNKNOWN_PENALTY
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        self.unknown_id = next((i for i, (_, kind) in enumerate(pieces) if kind == UNKNOWN), 0)
        surface = []
        for i, (text, kind) in enumerate(pieces):
            if kind == BYTE:
                code = int(text[3:5], 16)
                self.byte_ids[code] = i
                surface.append(bytes([code]))
            elif kind == UNKNOWN:
                surface.append(" ⁇ ".encode())
            else:
                surface.append(b"" if kind == CONTROL else text.encode().replace(MARKER, b" "))
        self.has_bytes = bool((self.byte_ids >= 0).all())
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.surface_sizes = np.array([len(x) for x in surface], dtype=np.int64)
        self.surface_starts = np.cumsum(self.surface_sizes) - self.surface_sizes

    # --- search -----------------------------------------------------------

    def best_paths(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best path of each word, flat, and their number per word."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        group = np.searchsorted(WIDTHS, sizes)
        parts, owners = [], []
        for k, width in enumerate(WIDTHS):
            members = np.flatnonzero(group == k)
            for i in range(0, len(members), SIDE_BY_SIDE):
                some = members[i : i + SIDE_BY_SIDE]
                ids, counts = self._side_by_side([words[j] for j in some], sizes[some], width)
                parts.append(ids)
                owners.append(np.repeat(some, counts))
        for j in np.flatnonzero(group == len(WIDTHS)):
            ids = self._alone(words[j])
            parts.append(np.array(ids, dtype=np.int32))
            owners.append(np.full(len(ids), j))
        if not parts:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        ids, owners = np.concatenate(parts), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        return ids[order], np.bincount(owners, minlength=len(words))

    def _side_by_side(self, words: list[bytes], sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(words)
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(n, width)
        code = np.where(np.arange(width) < sizes[:, None], text, 256).astype(np.int32)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        came = np.zeros((n, width + 1), dtype=np.int32)
        took = np.full((n, width + 1), -1, dtype=np.int32)
        char = np.where(text < 0x80, 1, np.where(text >= 0xF0, 4, np.where(text >= 0xE0, 3, np.where(text >= 0xC0, 2, 0))))
        for s in range(width):
            live = np.flatnonzero((s < sizes) & (char[:, s] > 0))
            if not len(live):
                continue
            covered = np.zeros(n, dtype=bool)
            node = np.zeros(len(live), dtype=np.int32)
            rows = live
            for end in range(s + 1, width + 1):
                step = self.base[node] + code[rows, end - 1]
                ok = (self.check[step] == node) & (self.base[node] > 0)
                rows, node = rows[ok], step[ok]
                if not len(rows):
                    break
                piece = self.value[node]
                has = piece >= 0
                hit, ids = rows[has], piece[has]
                if len(hit):
                    sums = best[hit, s] + self.scores[ids]
                    covered[hit[end - s == char[hit, s]]] = True
                    better = sums > best[hit, end]
                    hit = hit[better]
                    best[hit, end], came[hit, end], took[hit, end] = sums[better], s, ids[better]
            bare = live[~covered[live]]
            if len(bare):
                end = np.minimum(s + char[bare, s], sizes[bare])
                sums = best[bare, s] + self.unknown_score
                better = sums > best[bare, end]
                bare, end = bare[better], end[better]
                best[bare, end], came[bare, end], took[bare, end] = sums[better], s, -1
        places, owners, ids = [], [], []
        rows, at = np.arange(n)[sizes > 0], sizes[sizes > 0].copy()
        while len(rows):
            start, piece = came[rows, at], took[rows, at]
            missing = np.flatnonzero(piece < 0)
            if self.has_bytes and len(missing):
                span = at[missing] - start[missing]
                own = np.repeat(missing, span)
                place = np.concatenate([np.arange(a, b) for a, b in zip(start[missing], at[missing])])
                places.append(place)
                owners.append(rows[own])
                ids.append(self.byte_ids[text[rows[own], place]])
                present = np.flatnonzero(piece >= 0)
            else:
                piece = np.where(piece < 0, self.unknown_id, piece)
                present = np.arange(len(rows))
            places.append(start[present])
            owners.append(rows[present])
            ids.append(piece[present])
            more = start > 0
            rows, at = rows[more], start[more]
        if not ids:
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        owners, places, ids = np.concatenate(owners), np.concatenate(places), np.concatenate(ids)
        order = np.argsort(owners * np.int64(width + 1) + places)
        return ids[order].astype(np.int32), np.bincount(owners, minlength=n)

    def _alone(self, word: bytes) -> list[int]:
        """The same search for one word of any length, one character at a time."""
        n = len(word)
        base, check, value, scores = self.base, self.check, self.value, self.scores
        best, came, took = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for s in range(n):
            lead = word[s]
            if 0x80 <= lead < 0xC0:
                continue
            size = 1 if lead < 0x80 else 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2
            node, covered = 0, False
            for end in range(s + 1, n + 1):
                step = base[node] + word[end - 1]
                if check[step] != node or base[node] == 0:
                    break
                node = step
                piece = value[node]
                if piece >= 0:
                    covered |= end - s == size
                    total = best[s] + scores[piece]
                    if total > best[end]:
                        best[end], came[end], took[end] = total, s, int(piece)
            if not covered and best[s] + self.unknown_score > best[s + size]:
                best[s + size], came[s + size], took[s + size] = best[s] + self.unknown_score, s, -1
        ids, at = [], n
        while at:
            start = came[at]
            if took[at] >= 0:
                ids.append(took[at])
            elif self.has_bytes:
                ids += [int(self.byte_ids[c]) for c in reversed(word[start:at])]
            else:
                ids.append(self.unknown_id)
            at = start
        return ids[::-1]

    # --- whole texts --------------------------------------------------------

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and their number per text."""
        known = WordIds()
        numbers, sizes = [], []
        for text in texts:
            words = split_words(text)
            sizes.append(len(words))
            numbers.append(np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)))
        if not known:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ids, counts = self.best_paths([MARKER + w.replace(b" ", MARKER) for w in known])
        numbers = np.concatenate(numbers)
        starts = np.cumsum(counts) - counts
        per_word = counts[numbers]
        flat = _gathered(ids, starts[numbers], per_word)
        ends = np.concatenate([[0], np.cumsum(per_word)])
        bounds = ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
        return flat, np.diff(bounds)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Texts of consecutive runs of ids; bytes that are no UTF-8 become U+FFFD."""
        sizes = self.surface_sizes[ids]
        data = _gathered(self.surface, self.surface_starts[ids], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)].tolist()
        out = []
        for begin, end in zip(ends, ends[1:]):
            text = data[begin:end]
            text = text[1:] if text[:1] == b" " else text
            out.append(text.decode("utf-8", "replace").encode())
        return out


def _after_markers(key: bytes) -> bytes:
    while key.startswith(MARKER):
        key = key[len(MARKER) :]
    return key


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of consecutive runs laid end to end."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """Runs of values laid end to end; the indices, eight bytes each, of ``step`` runs at a time."""
    parts = [values[_runs(starts[i : i + step], sizes[i : i + step])] for i in range(0, len(sizes), step)]
    return np.concatenate(parts) if parts else values[:0]


def split_words(text: bytes) -> list[bytes]:
    """Parts that each stand for a leading blank and what follows up to the next blank that ends a word."""
    if not text:
        return []
    if text[0] != 32 and text[-1] != 32 and b"  " not in text:
        return text.split(b" ")
    return [x[1:] for x in re.findall(rb" +[^ ]+| +", b" " + text)]


def encoded(documents: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """The documents' columns with ``piece_ids`` and ``round_trip``: whether decoding gives the text back."""
    # plain arrays, so that executors need no importable copy of this package to read them
    shared = documents.sparkSession.sparkContext.broadcast(vars(Codec(read_model(model_path))))
    own = [f for f in documents.schema.fields if f.name.lower() not in ("piece_ids", "round_trip")]
    frame = documents.select(*(F.col(f"`{f.name}`") for f in own))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own) + ", piece_ids array<int>, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.__new__(Codec)
        vars(codec).update(shared.value)
        for batch, bodies in with_bytes(batches, 4 << 20):
            texts = bodies.to_pylist()
            ids, counts = codec.encode(texts)
            same = [a == b for a, b in zip(codec.decode(ids, counts), texts)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in own), ragged(ids, counts, pa.int32()), pa.array(same, type=pa.bool_())],
                names=[*(f.name for f in own), "piece_ids", "round_trip"],
            )

    return frame.mapInArrow(run, schema)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))
    first_byte, last_byte = 3, 258
    return rows.select(
        "doc_id",
        F.size("piece_ids").cast("bigint").alias("n_pieces"),
        F.size(F.filter("piece_ids", lambda i: i.between(first_byte, last_byte))).cast("bigint").alias("n_byte_pieces"),
        "piece_ids",
        "round_trip",
    )
