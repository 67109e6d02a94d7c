"""Spelling variants against brute force over all pairs."""

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import spelling
from millrace.session import materialize


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts: dict[str, int], ratio: int = 5) -> dict[str, tuple]:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, around in near.items():
        best = min(around, key=lambda v: (-counts[v], v.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (form[w], root, counts[w], len(near[w]), None if form[w] is None else counts[form[w]])
    return rows


def spelled(texts: list[tuple]) -> dict[str, int]:
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def as_dict(df) -> dict[str, tuple]:
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("symbols", [2, 8])
def test_variants_equal_brute_force(spark, symbols):
    draw = __import__("random").Random(7)
    counts = {}
    for _ in range(60):
        word = "".join(draw.choice("abcé") for _ in range(draw.randint(3, 7)))
        counts[word] = draw.choice([5, 25, 26, 130, 700])
        k = draw.randrange(len(word))
        counts[word[:k] + word[k + 1 :]] = draw.choice([1, 5, 28])
        counts[word[:k] + "z" + word[k:]] = draw.choice([1, 5, 5])
    counts |= {"漢字漢字漢字": 50, "漢字漢字漢": 10, "😀😀": 5, "😀é": 25, "x": 5, "": 30}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    assert as_dict(spelling.variants(words, symbols=symbols)) == brute(counts)


def test_long_ways_ties_and_repeated_words(spark):
    # a way of six forms, and a tie between two forms of one count
    way = {"a" * k: 5**k for k in range(1, 8)}
    ties = {"kettle": 5, "kettlf": 25, "kettla": 25}
    counts = way | ties
    rows = list(counts.items()) + [("kettle", 0), (None, 4), ("zz", None), ("twice", 2), ("twice", 3)]
    words = spark.createDataFrame([(w, n, "x", "y") for w, n in rows], "word string, n bigint, root string, form string")
    got = as_dict(spelling.variants(words))
    assert got == brute(counts | {"twice": 5})
    assert got["a"][1] == "a" * 7 and got["kettle"][0] == "kettla"


def test_word_counts_and_query_rows(spark, documents, nothing, texts):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.word: r.n for r in spelling.word_counts(documents).collect()}
    assert got == spelled(rows)
    assert spelling.word_counts(nothing).count() == 0
    assert spelling.variants(spelling.word_counts(nothing)).count() == 0
    accents = [(k, f"ÉCOLIERS écoliers Straße×÷ naïveté{k} {'y' * 5}") for k in range(30)] + [(None, None), (3, "")]
    small = spark.createDataFrame(accents, "doc_id bigint, text string")
    assert {r.word: r.n for r in spelling.word_counts(small).collect()} == spelled(accents)


def test_query_on_a_table_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert as_dict(spelling.op11_spelling(spark, sf)) == brute(spelled(rows))


def test_neighbourhood_is_full(spark):
    row = spark.createDataFrame([("ab",)], "w string").select(spelling.neighbourhood(F.col("w"), 3).alias("k")).first()
    want = {"ab", "a", "b"}
    want |= {c + "b" for c in "abc"} | {"a" + c for c in "abc"}
    want |= {x for c in "abc" for x in (c + "ab", "a" + c + "b", "ab" + c)}
    assert len(row.k) == len(set(row.k)) and set(row.k) == want


def test_neighbourhoods_are_not_broadcast(spark):
    # a table far below the limit of a broadcast, whose neighbourhoods are not
    words = spark.createDataFrame([("kettle", 5), ("kettla", 25)], "word string, n bigint").withColumn("reduced", spelling.reduced(F.col("word")))
    pairs = spelling.near_pairs(materialize(words, "few"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted((r.word, r.near_word, r.near_n) for r in pairs.collect()) == [("kettla", "kettle", 5), ("kettle", "kettla", 25)]


def test_refused_parameters(spark):
    words = spark.createDataFrame([], "word string, n bigint")
    for bad in ({"ratio": 1}, {"symbols": 1}):
        with pytest.raises(ValueError):
            spelling.variants(words, **bad)
