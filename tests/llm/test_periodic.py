"""Periodic runs against brute force over all starts and periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from millrace.llm import periodic


def brute(words: list, min_length: int = 24, min_periods: int = 3) -> list[tuple[int, int, int]]:
    """Every maximal stretch with period q, kept if no smaller period holds in it."""
    n = len(words)
    found = []
    for q in range(1, n // min_periods + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(min_length, min_periods * q):
                inside = words[start : start + length]
                if not any(inside[p:] == inside[:-p] for p in range(1, q)):
                    found.append((start, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = best[0] if best[0] is None else 1000 * best[1] // best[2]
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return doc_id, len(runs), *best, milli, sha(listed), sha(kept)


def texts_with_runs() -> list[str]:
    draw = random.Random(3)
    plain = lambda n, letters="abcdefgh": [draw.choice(letters) for _ in range(n)]
    texts = [["x"] * n for n in (1, 23, 24, 25, 200)]
    texts += [plain(n, "ab") for n in (24, 100, 400)] + [plain(300, "abc")]
    for q in (2, 3, 7, 8, 9, 12, 15, 16, 17, 31, 32, 33, 50, 64, 65):
        unit = plain(q)
        for times in (2.9, 3, 3.4, 8):
            k = int(q * times)
            texts.append(plain(20) + (unit * 9)[:k] + plain(20))
    # runs side by side, sharing words, and periods inside periods
    unit = plain(5)
    texts.append(unit * 8 + unit[:2] + plain(6) * 5 + ["a"] * 30 + (["a"] * 6 + ["b"]) * 6)
    texts.append((["a", "b"] * 13 + ["c"]) * 4)
    texts.append(([*"aab"] * 9 + ["c"]) * 3 + [*"aab"] * 9)
    texts.append([w for k in range(40) for w in ("é", "漢字", f"w{k % 2}")])
    return [" \t".join(t) for t in texts]


def test_runs_equal_brute_force(spark):
    texts = texts_with_runs()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.periodic(rows).collect()}
    assert got == {k: brute(t.split()) for k, t in enumerate(texts)}
    assert sum(map(len, got.values())) > 40


def test_random_small_alphabets_and_bounds():
    draw = random.Random(11)
    for least, periods in ((24, 3), (6, 3), (12, 4), (9, 5)):
        texts = []
        for _ in range(150):
            unit = [draw.choice("ab") for _ in range(draw.randint(1, 12))]
            text = unit * draw.randint(1, 8) + [draw.choice("ab") for _ in range(draw.randint(0, 12))]
            if draw.random() < 0.5:
                text[draw.randrange(len(text))] = "c"
            texts.append([w.encode() for w in text])
        got = periodic.find_runs(texts, least, periods)
        assert got == [brute(t, least, periods) for t in texts]


def test_query_equals_brute_force(spark, sf, documents, tmp_path):
    folder = str(tmp_path / "awkward")
    # ids whose crc32 ends in 0 get a repeated tail
    edited = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    extra = [(i, " ".join(f"w{k % 37}" for k in range(3 * i % 91)), None, None, None, "r", "m", "b", "t", "p", "q") for i in edited]
    rows = documents.where("doc_id is null or doc_id <> 13").union(spark.createDataFrame(extra, documents.schema))
    rows.write.parquet(f"{folder}/documents.parquet")
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = sorted((tuple(r[c] for c in columns) for r in periodic.op12_periodic(spark, folder).collect()), key=str)
    want = sorted((expected(r.doc_id, r.text) for r in rows.collect()), key=str)
    assert got == want and any(r[1] for r in want)


def test_query_on_a_table_equals_brute_force(spark, sf, texts):
    short = {i for i, t in texts.items() if len(t) < 6000}
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = {r.doc_id: tuple(r[c] for c in columns) for r in periodic.op12_periodic(spark, sf).collect()}
    assert set(got) == set(texts)
    # the brute force is quadratic, so it takes the shorter texts
    assert {i: got[i] for i in short} == {i: expected(i, texts[i]) for i in short}


def test_very_long_text_of_one_word_and_empty_table(spark, nothing):
    rows = spark.createDataFrame([(1, "a " * 300_000), (None, None), (2, ""), (2, " \n")], "doc_id bigint, text string")
    got = sorted(periodic.periodic(rows).collect(), key=lambda r: (str(r.doc_id), r.n_words))
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (1, 300_000, [(0, 300_000, 1)], "a"), (2, 0, [], ""), (2, 0, [], ""), (None, 0, [], ""),
    ]
    assert periodic.periodic(nothing).count() == 0


def test_refused_bounds(spark, nothing):
    for bad in ((24, 2), (2, 3)):
        with pytest.raises(ValueError):
            periodic.periodic(nothing, *bad)
